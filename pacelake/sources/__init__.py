from pacelake.sources.tables import read_table  # noqa: F401
from pacelake.sources.feed import race_feed  # noqa: F401
from pacelake.sources.results_csv import read_results, read_results_text  # noqa: F401
from pacelake.sources.sinks import append_stream, drop_batch  # noqa: F401
