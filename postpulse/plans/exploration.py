"""First look at a post table with one yes/no popularity flag.

The earlier of the two pipelines: sample first, then features on the raw text.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import DataFrame

from postpulse.operators.bow import bag_of_words_wide, vocabulary
from postpulse.operators.features import (
    add_meta_features,
    add_slow_features,
    lexicon_polarity,
    token_flags,
)
from postpulse.operators.labels import drop_missing
from postpulse.operators.ngrams import stop_words, text_trends, word_frequencies
from postpulse.operators.sampling import balanced_sample
from postpulse.sources import materialise

WATCHED = ("sell", "buy")


class Exploration:
    """Half of `rows` posts per value of `flag`, described from several sides.

    Posts with any missing value are dropped first. The sample is stored once, and
    flags, unknown words, polarity and vocabulary use its bodies as they are.
    """

    def __init__(
        self,
        posts: DataFrame,
        flag: str,
        rows: int = 5000,
        words: int = 100,
        strict: bool = True,
        seed: int | str = 42,
    ):
        picked = balanced_sample(drop_missing(posts), flag, rows // 2, seed=seed, strict=strict)
        self.flag, self.words = flag, words
        self.sample = materialise(picked, "explored")

    @cached_property
    def vocabulary(self) -> DataFrame:
        """The most frequent terms of the sample."""
        return materialise(vocabulary(self.sample, self.words), "vocabulary")

    def matrix(
        self,
        terms: DataFrame,
        dictionary: DataFrame,
        lexicon: DataFrame,
        watched: Iterable[str] = WATCHED,
    ) -> DataFrame:
        """The sample with all text features and one count column per term."""
        described = add_slow_features(add_meta_features(self.sample), terms, dictionary)
        scored = lexicon_polarity(token_flags(described, list(watched)), lexicon)
        texts = self.sample.select("tweet_id", "body")
        counts = bag_of_words_wide(texts, self.vocabulary, self.words).drop("body")
        return scored.join(counts, "tweet_id")

    def trends(self, stop: Iterable[str] | None = None) -> DataFrame:
        """Top word and character n-grams per value of the flag."""
        return text_trends(self.sample, self.flag, stop=stop)

    def frequencies(self, stop: Iterable[str] | None = None) -> DataFrame:
        """The most frequent words of the sample that are not stop words."""
        return word_frequencies(self.sample, stop_words() if stop is None else stop)
