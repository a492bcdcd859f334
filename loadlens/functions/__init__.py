"""Column expressions (all built-in, codegen-friendly)."""

from loadlens.functions.time import (  # noqa: F401
    data_day, day_no, day_to_label, epoch_seconds, jst_hour, label_of_t,
    latenight_label, weekday_no, yyyymm, yyyymmdd,
)
from loadlens.functions.power import null_safe_sum, power_kept  # noqa: F401
from loadlens.functions.keys import provider_id, row_key  # noqa: F401
