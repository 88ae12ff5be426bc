"""Language identification by language-bitmask n-gram filters.

One bit-sliced Bloom filter holds the n-grams of all languages: each position is a bitmask with one bit per
language, and the AND of an n-gram's positions gives at once every language that contains it. A document is
decided by counting, per language, the n-grams whose mask has its bit, corrected for the false positives
that the language's share of set bits makes likely.

An n-gram belongs to a language if it occurs in at least `SUPPORT` of the language's training documents, so
a language holds at most 1/SUPPORT times the mean number of distinct n-grams a document: the filter has a
proven size and is sent to the tasks. Training reads about `PER_LANGUAGE` whole documents a language, chosen
by a hash of id and text, each once whatever number of rows it has; prediction reads every whole text.

Defined results: a text that is NULL or has no letter is `und` with score 0; if nothing could be learned,
every document is. Equal counts go to the language with more training documents, then by name. Repeated
rows are predicted alike. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import common, ngrams

N, HASHES, BITS_PER_GRAM, SUPPORT, PER_LANGUAGE = 3, 4, 24, 0.05, 4000
UNKNOWN = "und"


class Filter:
    """Bit-sliced Bloom filter: `slices` has one row of 64-bit language masks per position."""

    def __init__(self, languages: list[str], positions: int):
        self.languages = languages
        self.slices = np.zeros((positions, -(-max(len(languages), 1) // 64)), np.uint64)

    def add(self, position: int, language: int) -> None:
        self.slices[position, language // 64] |= np.uint64(1 << language % 64)

    def false_positives(self) -> np.ndarray:
        """Chance per language that an n-gram it lacks is reported."""
        return np.array([((self.slices[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(self.languages))]) ** HASHES

    def masks(self, grams: np.ndarray) -> np.ndarray:
        found = self.slices[positions_of(grams, 0, len(self.slices))]
        for i in range(1, HASHES):
            found = found & self.slices[positions_of(grams, i, len(self.slices))]
        return found


def positions_of(grams: np.ndarray, i: int, positions: int) -> np.ndarray:
    """Position number `i` of each n-gram: double hashing, `positions` a power of two."""
    step = (grams >> np.uint64(32)) | np.uint64(1)
    return ((grams + np.uint64(i) * step) & np.uint64(positions - 1)).astype(np.int64)


def learn(docs: DataFrame) -> Filter:
    """The filter of all languages of `docs` (`doc_id`, `text`, `lang`; NULL languages left out)."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    # rows of equal id and text are one document; their number is estimated, as the sample's size is
    document = F.xxhash64("doc_id", F.lit(7), "text")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(document).alias("documents")).collect()
    counts, documents = {r.lang: r.n for r in sizes}, {r.lang: max(r.documents, 1) for r in sizes}
    languages = sorted(counts, key=lambda lang: (-counts[lang], lang))
    if not languages:
        return Filter([], 1)
    share = F.element_at(F.create_map(*(F.lit(x) for lang in languages for x in (lang, common.share_of(PER_LANGUAGE, documents[lang])))), F.col("lang"))
    drawn = known.where(document.bitwiseAND(F.lit(2**63 - 1)) <= share).withColumn("document", document)
    sample = common.one_per_document(drawn, "lang", "document")

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                count: Counter = Counter()
                for text in group["text"]:
                    codes = ngrams.plain(text)
                    grams = [np.unique(ngrams.hashes(p, N)) for p in ngrams.pieces(codes, N)] if len(codes) else []
                    if grams:
                        count.update(np.unique(np.concatenate(grams)).view(np.int64).tolist())
                rows = pd.DataFrame({"gram": list(count), "docs": list(count.values())}, dtype="int64")
                yield pd.concat([rows, pd.DataFrame({"gram": [None], "docs": [len(group)]})]).assign(lang=lang).astype({"gram": "Int64", "docs": "int64"})[["lang", "gram", "docs"]]

    found = sample.select("lang", "text").mapInPandas(seen, "lang string, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
    sizes = found.where("gram is null").select("lang", F.col("docs").alias("size"))
    kept = found.where("gram is not null").join(F.broadcast(sizes), "lang").where(F.col("docs") >= F.col("size") * SUPPORT).select("lang", "gram").collect()
    per_language = Counter(r.lang for r in kept)
    made = Filter(languages, 1 << max(10, (BITS_PER_GRAM * max(per_language.values(), default=1)).bit_length()))
    for i, lang in enumerate(languages):
        grams = np.array([r.gram for r in kept if r.lang == lang], np.int64).view(np.uint64)
        for k in range(HASHES):
            made.slices[positions_of(grams, k, len(made.slices)), i // 64] |= np.uint64(1 << i % 64)
    return made


def decide(text: str | None, filter_: Filter, false_positives: np.ndarray) -> tuple[str, float]:
    codes = ngrams.plain(text or "")
    if not len(codes) or not filter_.languages:
        return UNKNOWN, 0.0
    hits, total = np.zeros(len(filter_.languages)), 0
    for piece in ngrams.pieces(codes, N):
        masks = filter_.masks(ngrams.hashes(piece, N))
        total += len(masks)
        for i in range(len(hits)):
            hits[i] += np.count_nonzero(masks[:, i // 64] & np.uint64(1 << i % 64))
    real = np.clip((hits - total * false_positives) / np.maximum(1 - false_positives, 1e-9), 0, None)
    best = int(real.argmax())
    return filter_.languages[best], float(real[best] / real.sum()) if real.any() else 0.0


def identify(docs: DataFrame, filter_: Filter) -> DataFrame:
    """`doc_id, lang_pred, score` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(filter_)

    @F.pandas_udf("lang_pred string, score double")
    def of_text(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rates = sent.value.false_positives()
        for batch in texts:
            yield pd.DataFrame([decide(t, sent.value, rates) for t in batch], columns=["lang_pred", "score"])

    return docs.select("doc_id", of_text("text").alias("p")).select("doc_id", "p.lang_pred", "p.score")


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """As `identify`, learned from the rows that are not held out."""
    found = identify(docs, learn(docs.where(~common.held_out())))
    return found.select("doc_id", common.held_out().alias("held_out"), "lang_pred", "score")
