"""Print the formatted physical plan of registered queries.

``python -m stayrate.plans.explain customer_features [more names] [--sf DIR]``
"""

from __future__ import annotations

import sys


def explain(spark, name: str, sf_dir: str, mode: str = "formatted") -> str:
    from stayrate.plans import QUERIES
    df = QUERIES[name](spark, sf_dir)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def main(argv):
    from stayrate.session import get_spark
    sf_dir = "/root/testdata/sf0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf_dir = argv[i + 1]
        argv = argv[:i] + argv[i + 2:]
    spark = get_spark("local[8]", 8)
    for name in argv:
        print(f"==== {name}")
        print(explain(spark, name, sf_dir))


if __name__ == "__main__":
    main(sys.argv[1:])
