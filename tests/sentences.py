"""The sentences of the fixed-batch examples."""

FIXED_BATCH_SENTENCES = (
    "the cow jumped over the moon",
    "the man went to the store and bought some candy",
    "four score and seven years ago",
    "how many apples can you eat",
    "to be or not to be the person",
)
