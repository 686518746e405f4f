"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams (one to three letters, words padded by a space) in order. A
document's own list is compared with each language's by the out-of-place distance: the sum over its n-grams of
how far apart the two ranks are, and the full length of a profile where the language lacks the n-gram.

Profiles count every labelled training text in full. Each partition sums its counts by language before they are
shuffled, so a source with a third of all rows costs no more than any other.

Defined cases: a text without letters, null or empty is `und` with score zero, as is every text where nothing was
learned. Rows without a language or id are predicted like others; a null id counts as an empty one for the split.
Ties between languages go to the first in order, ties between n-grams to the lower code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mdlake.llm.common import park, text_batches

UNKNOWN = "und"
PROFILE = 400
#: Languages up to which profiles are broadcast; more are an error.
MAX_LANGUAGES = 2000
PARTS = 64
#: Score below which a text is in none of the learned languages.
MIN_SCORE = 0.25
_SPACE = 32
#: Characters that are counted at a time.
_CHARS = 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> np.ndarray:
    """Codes of the n-grams of a text, repeats included: 21 bits a character."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, _SPACE).astype(np.int64)
    space = points == _SPACE
    keep = np.ones(len(points), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    points, space = points[keep], space[keep]
    two = points[:-1] << 21 | points[1:]
    three = two[:-1] << 21 | points[2:]
    return np.concatenate([points[~space], two, three[~space[1:-1]]])


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.diff(np.append(first, len(codes)))


def profile_of(text: str, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams of a text, most frequent first."""
    codes, counts = counted(ngrams(text))
    return codes[np.argsort(-counts, kind="stable")[:size]]


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def held_out(id_: str | Column = "doc_id") -> Column:
    id_ = F.col(id_) if isinstance(id_, str) else id_
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % 4 == 2


def learn_profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """(lang, rank, code): the profile of each language of the labelled rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        held: dict[str, list[np.ndarray]] = {}

        def settle(lang: str) -> None:
            codes, counts = counted(np.concatenate(held.pop(lang)))
            if lang in sums:
                both = np.concatenate([sums[lang][0], codes])
                codes, back = np.unique(both, return_inverse=True)
                counts = np.bincount(back, np.concatenate([sums[lang][1], counts]), len(codes)).astype(np.int64)
            sums[lang] = codes, counts

        waiting: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                lang, text = lang.as_py(), text.as_py()
                held.setdefault(lang, []).append(ngrams(text))
                waiting[lang] = waiting.get(lang, 0) + len(text)
                if waiting[lang] > _CHARS:
                    settle(lang)
                    waiting[lang] = 0
        for lang in list(held):
            settle(lang)
        for lang, (codes, counts) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes), pa.array(counts)], names=["lang", "code", "n"])

    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sums = text_batches(rows).mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # Each of PARTS parts of a language gives its own first ones, so no language meets in one task as a whole.
    first = sums.withColumn("part", F.pmod(F.xxhash64("code"), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        first = first.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("n").desc(), "code"))).filter(F.col("rank") <= size)
    return first.select("lang", (F.col("rank") - 1).alias("rank"), "code")


class Profiles:
    """Ranks of every profiled n-gram in each language; the penalty where a language lacks it."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE):
        self.size, self.langs = size, sorted({lang for lang, _, _ in rows})
        self.codes = np.unique(np.array([code for _, _, code in rows], np.int64))
        self.ranks = np.full((len(self.codes), len(self.langs)), -1, np.int64)
        for lang, rank, code in rows:
            self.ranks[np.searchsorted(self.codes, code), self.langs.index(lang)] = rank

    def closest(self, text: str | None) -> tuple[str, float]:
        """The language of least distance, and one less that distance as a share of the largest possible."""
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        codes = profile_of(text, self.size)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        theirs = np.where((self.codes[at] == codes)[:, None], self.ranks[at], -1)
        apart = np.where(theirs >= 0, np.abs(theirs - np.arange(len(codes))[:, None]), self.size).sum(0)
        best = int(apart.argmin())
        return self.langs[best], 1.0 - float(apart[best]) / (self.size * len(codes))


def identify(docs: DataFrame, profiles: DataFrame, text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """docs with lang_pred and score. profiles has `size` rows a language and is broadcast."""
    rows = profiles.select("lang", "rank", "code").limit(MAX_LANGUAGES * size + 1).collect()
    if len(rows) > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    shared = docs.sparkSession.sparkContext.broadcast(Profiles([tuple(r) for r in rows], size))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], *([] if text_col in kept else [F.col(f"`{text_col}`").alias("t")]))
    at = kept.index(text_col) if text_col in kept else len(kept)
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.closest(t.as_py()) for t in batch.columns[at]]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=schema.names)

    return text_batches(named).mapInArrow(run, schema)


def keep_known(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of docs in one of the languages that their labelled rows teach, with their own columns.

    Texts without a letter go, and texts that score less than min_score in every language. A language that was seen
    too little to fill its profile rejects nothing. A row without a language gets the predicted one. Where no row has
    a language nothing can be told apart, and every text with a letter stays.
    """
    profiles = park(learn_profiles(docs.filter(~held_out(F.col(f"`{id_col}`"))), lang_col, text_col), "profiles")
    if profiles.isEmpty():
        return docs.filter(F.col(f"`{text_col}`").rlike(r"\p{IsAlphabetic}"))
    columns = docs.columns
    short = [r["lang"] for r in profiles.groupBy("lang").count().filter(F.col("count") < PROFILE).limit(MAX_LANGUAGES).collect()]
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    found = identify(named, profiles, f"c{columns.index(text_col)}").filter((F.col("lang_pred") != UNKNOWN) & ((F.col("score") >= min_score) | F.col("lang_pred").isin(short)))
    own = lambda i, c: F.coalesce(F.col(f"c{i}").cast("string"), "lang_pred") if c == lang_col else F.col(f"c{i}")
    return found.select(*[own(i, c).alias(c) for i, c in enumerate(columns)])
