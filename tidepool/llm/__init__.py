"""Operators of a training-data pipeline.

One module per operator (``pii``, ``toxicity``, ``exact_dedup``, ``html_text``,
``bpe``, ``suffix_dedup``, ``jaccard_join``, ``langid``, ``decontaminate``,
``chat_format``); ``catalog`` registers their queries and ``oracle`` holds the
SQL of those that SQL can express.  Nothing else in the library imports this
package.
"""
