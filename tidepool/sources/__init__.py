from tidepool.sources.batches import cycled, with_batch_id, with_partitioned_batch_id
from tidepool.sources.choice import (
    CLOJURE_SENTENCES, PARAMETERIZED_EXAMPLE, RANDOM_SENTENCES,
    choice, choice_source, choice_stream, pick_index,
)
from tidepool.sources.requests import requests_from, requests_stream, write_results
from tidepool.sources.tables import TABLES, events_as_words, table

__all__ = [
    "cycled", "with_batch_id", "with_partitioned_batch_id", "CLOJURE_SENTENCES",
    "PARAMETERIZED_EXAMPLE", "RANDOM_SENTENCES", "choice",
    "choice_source", "choice_stream", "pick_index", "requests_from", "requests_stream",
    "write_results", "TABLES", "events_as_words", "table",
]
