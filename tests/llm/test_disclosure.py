"""The law of disclosing terms against counts by plain Python, and very long texts."""

import math
from collections import Counter, defaultdict

import regex
from cases import SF, docs
from parcelflow.llm import common, pii
from test_models_and_search import plain_spans

EMAIL = regex.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def entities(text):
    found = set()
    for span in filter(None, plain_spans(text)):
        kind, start, end = span.split(":")
        part = text[int(start) : int(end)]
        found.add((kind, part.lower() if kind in ("email", "ip") else regex.sub("[^0-9]", "", part)))
    return found


def wanted_terms(rows):
    """Id and term of every pair that the law flags, over all documents and every number of documents an entity has."""
    n, terms, held = len(rows), {}, {}
    for i, text in rows:
        plain = EMAIL.sub("@", text or "")
        terms[i], held[i] = {t.lower() for t in regex.findall(pii.TERM, plain)}, entities(text or "")
    n_e, n_t, n_et = Counter(e for s in held.values() for e in s), Counter(t for s in terms.values() for t in s), Counter()
    for i, _ in rows:
        n_et.update((e, t) for e in held[i] for t in terms[i])
    flagged, sizes = defaultdict(set), set()
    for i, _ in rows:
        for e in held[i]:
            for t in terms[i]:
                shrunk = n_et[e, t] - pii.SHRINK * (1 - 1 / n_e[e])
                if n_e[e] < n and math.log(n * shrunk / (n_e[e] * n_t[t])) / math.log(n / n_e[e]) >= pii.THRESHOLD:
                    flagged[i].add(t)
                    sizes.add(n_e[e])
    return flagged, sizes


def found_terms(frame, texts):
    found = defaultdict(set)
    for r in pii.report(frame).collect():
        for span in r.spans.split(","):
            if span.startswith("term:"):
                _, start, end = span.split(":")
                found[r.doc_id].add(texts[r.doc_id][int(start) : int(end)].lower())
    return found


def test_law_against_plain_counts(spark):
    rows = [tuple(r) for r in common.read(spark, SF, "documents").select("doc_id", "text").collect()]
    wanted, _ = wanted_terms(rows)
    assert found_terms(common.read(spark, SF, "documents"), dict(rows)) == wanted and sum(map(len, wanted.values())) > 50


def test_law_has_no_step_in_the_number_of_documents(spark):
    """A name in two documents of an entity and nowhere else is flagged, whether the entity has two, three or five documents."""
    rows, number = [], 0
    for size in (1, 2, 3, 4, 5, 8):
        for k in range(size):
            name = f" Name{'abcdefgh'[size - 1]}" if k < 2 else ""
            rows.append((number, f"mail e{size}@mail.example now{name}"))
            number += 1
    rows += [(number + i, "mail nobody now") for i in range(200)]
    wanted, sizes = wanted_terms(rows)
    frame = docs(spark, [(i, t, "en", None, 0) for i, t in rows])
    assert found_terms(frame, dict(rows)) == wanted and {1, 2, 3, 4, 5} <= sizes


def test_very_long_text_with_an_entity(spark):
    """Half a million words, all in one text and no two alike: each gets its place."""
    words = [f"w{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i // 100 % 10]}" for i in range(500_000)]
    text = "10.0.0.1 " + " ".join(words)
    rows = [(1, text, "en", None, 0)] * 2 + [(10 + i, "nothing here", "en", None, 0) for i in range(60)]
    found = pii.report(docs(spark, rows)).where("doc_id = 1").collect()
    assert len(found) == 2 and found[0] == found[1]
    spans = [s.split(":") for s in found[0].spans.split(",")]
    assert spans[0] == ["ip", "0", "8"] and len(spans) == 500_001
    assert all(text[int(a) : int(b)] == words[i] for i, (_, a, b) in enumerate(spans[1:]))
