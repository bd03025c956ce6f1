from tidemark.functions.nulls import ratio, strict_greatest, strict_least
from tidemark.functions.text import (
    arrays_intersect,
    arrays_intersect_case_insensitive,
    clean_string,
    first_n_words,
    first_n_words_filtered,
    is_integer,
    unique_ngrams,
)
from tidemark.functions.web import (
    date_normalizer,
    domain_normalizer,
    ip_to_number,
    ip_trio,
    normalize_city,
    to_day,
    url_host,
)

__all__ = [
    "arrays_intersect",
    "arrays_intersect_case_insensitive",
    "clean_string",
    "date_normalizer",
    "domain_normalizer",
    "first_n_words",
    "first_n_words_filtered",
    "ip_to_number",
    "ip_trio",
    "is_integer",
    "normalize_city",
    "ratio",
    "strict_greatest",
    "strict_least",
    "to_day",
    "unique_ngrams",
    "url_host",
]
