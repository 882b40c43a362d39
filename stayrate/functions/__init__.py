from stayrate.functions.bands import (age_band, fee_band, tenure_band, right_closed_band,
                                      right_closed_ordinal, open_ended_band)
from stayrate.functions.dates import (as_date, days_between, tenure_days, tenure_years,
                                      day_of_week, month_bucket, days_before)
from stayrate.functions.numeric import (safe_div, clip_lower, log_target, inverse_log_target,
                                        money_sum, money_avg, rate_percent, round_half_up)
from stayrate.functions.encoding import dictionary, distinct_levels, label_encode, one_hot, one_hot_vector
