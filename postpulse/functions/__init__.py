"""Column expressions: text features, ordered choice, tokenisers."""

from postpulse.functions.choice import choose
from postpulse.functions.text import (
    META_FEATURES,
    clean_reviews_text,
    clean_text,
    count_tokens,
    letters_only,
    upper_word_list,
    vocabulary_tokens,
    word_tokens,
    words,
)

__all__ = [
    "META_FEATURES",
    "choose",
    "clean_reviews_text",
    "clean_text",
    "count_tokens",
    "letters_only",
    "upper_word_list",
    "vocabulary_tokens",
    "word_tokens",
    "words",
]
