"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Functions that run inside tasks are shipped with the job, so that executors need no copy of the package.
"""

from pyspark import cloudpickle

from slumberline.llm import decontaminate, html_text, near_dups, quality, recurring, simhash, spelling
from slumberline.llm import substring_dedup, suffix_dedup, tokens, whitening

for _module in (
    tokens,
    decontaminate,
    html_text,
    near_dups,
    quality,
    recurring,
    simhash,
    spelling,
    substring_dedup,
    suffix_dedup,
    whitening,
):
    cloudpickle.register_pickle_by_value(_module)
