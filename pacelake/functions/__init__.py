from pacelake.functions.parsing import (  # noqa: F401
    blank_to_null,
    first_number,
    has_hms,
    has_number,
    hash_key,
    hms_seconds,
    leading_date,
    performance_unit,
    safe_double,
    trailing_unit,
)
from pacelake.functions.clean import clean_results  # noqa: F401
