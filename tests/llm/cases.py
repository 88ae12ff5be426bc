"""Small tables with everything that may go wrong in them, and plain versions of shared rules."""

from __future__ import annotations

import re
import zlib

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASHING = ["size", "kept", "fp", "rate", "doc", "tokens", "n", "bucket", "key_text", "units", "shard", "terms", "DIGEST", "score"]
LONG = " ".join(f"word{i % 977} of the long text number {i}" for i in range(8_000))
ROWS = [
    (None, None, None, None, None),
    (None, "the same text twice over here", "en", None, 3),
    (1, None, "en", "a", 0),
    (2, "", "fr", "a", 0),
    (2, "", "fr", "a", 0),
    (3, " \t\n\x0b\x0c\r ", None, "a", 7),
    (4, "the same text twice over here", "en", "a", 9),
    (5, "the same  text twice over\nhere", "en", "a", 9),
    (5, "the same  text twice over\nhere", "en", "a", 9),
    (6, "write to ann.b@mail.example.org or +1 (202) 555-0143, card 4111 1111 1111 1111 at 10.0.0.255 now", "en", "b", 1),
    (7, "ünïcödé ñandú über straße 😀 中文", "de", "b", 1),
    (8, "12 34 !!", "en", "b", 1),
    (9, LONG, "en", "b", len(LONG)),
    (10, "x" * 3_000, "en", "b", 3_000),
]


def docs(spark, rows=ROWS):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, DOCS)
    return frame.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHING)))


def is_held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4 == 2


def normalised(text) -> str:
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def least_labels(n: int, linked) -> list[int]:
    """The least reachable index of each node, by plain search."""
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if (label[a], label[b]) != (low, low):
                label[a] = label[b] = low
                changed = True
    return label
