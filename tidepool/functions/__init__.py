from tidepool.functions.render import render_item, render_list
from tidepool.functions.text import (
    EXCLAIM, QUESTION, REQUEST_EXCLAIM, append_suffix, split_java, split_python,
    split_rule, split_whitespace, suffix,
)
from tidepool.functions.timeops import BUCKET_SIZE, bucket, elapsed_seconds, micros, slot_start

__all__ = [
    "EXCLAIM", "QUESTION", "REQUEST_EXCLAIM", "append_suffix", "split_java", "split_python",
    "split_rule", "split_whitespace", "suffix", "render_item", "render_list",
    "BUCKET_SIZE", "bucket", "elapsed_seconds", "micros", "slot_start",
]
