"""Repetition inside a single document.

A document is repetitive when at least 30 % of its words lie in a run of five consecutive words that occurred before in
it. Before that exact rule, cheaper ones reject documents which cannot meet it; each is a necessary condition, so
their order never changes the result. The order is a short-circuit cascade: on a bounded sample, each rule's time and
the share it rejects are measured, and rules run by rejection per cost. One map, no shuffle.

Rules. *Length*: at least 20 words. *Vocabulary*: a covered word repeats an earlier one, so at most 70 % of the words are
new. *Pairs*: likewise at least 30 % of the pairs of neighbouring words, less one pair for each run, repeat. *Runs*: the exact
one.

Defined cases: null, empty and short texts have a share of 0 and are never found; rows sent twice come out once; rows with a
null id are left out.
"""

from __future__ import annotations

import time
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import words_of

MIN_WORDS, RUN, SHARE_PERCENT = 20, 5, 30
#: Bound of the sample on which the order of the rules is measured.
SAMPLE = 400
SHARES = "doc_id bigint, n_words int, repeated_words int, share double, line_share double, top_share double"


def repeated(words: list[str], run: int = RUN) -> int:
    """Words that lie in a run which already occurred, starting earlier."""
    n = len(words) - run + 1
    if n < 2:
        return 0
    seen: set[tuple] = set()
    end = total = 0
    for i, gram in enumerate(zip(*(words[k:] for k in range(run)))):
        if gram in seen:
            total += i + run - max(i, end)
            end = i + run
        else:
            seen.add(gram)
    return total


def _enough(words: list[str]) -> bool:
    return len(words) >= MIN_WORDS


def _vocabulary(words: list[str]) -> bool:
    return (len(words) - len(set(words))) * 100 >= len(words) * SHARE_PERCENT


def _pairs(words: list[str]) -> bool:
    again = len(words) - 1 - len(set(zip(words, words[1:])))
    return again * 100 * RUN >= len(words) * SHARE_PERCENT * (RUN - 1)


def _runs(words: list[str]) -> bool:
    return repeated(words) * 100 >= len(words) * SHARE_PERCENT


RULES = {"length": _enough, "vocabulary": _vocabulary, "pairs": _pairs, "runs": _runs}


def order_rules(texts: list[str], rules: dict = RULES) -> list[str]:
    """Rules by rejected share per second on the texts; a rule that rejects nothing comes last. ``runs`` stays among them:
    wherever it stands, all rules must hold."""
    docs = [words_of(t) for t in texts]
    gain = {}
    for name, rule in rules.items():
        began = time.perf_counter()
        kept = sum(map(rule, docs))
        cost = max(time.perf_counter() - began, 1e-9)
        gain[name] = (len(docs) - kept) / cost
    return sorted(rules, key=lambda r: -gain[r])


def plan(documents: DataFrame, sample: int = SAMPLE) -> list[str]:
    """The order of the rules, measured on at most ``sample`` documents of the first partitions; it bears on time only."""
    rows = documents.where("text is not null").select("text").limit(sample).collect()
    return order_rules([r.text for r in rows]) if rows else list(RULES)


def _found(order: list[str]):
    def run(batches):
        rules = [RULES[r] for r in order]
        for b in batches:
            out = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                if doc is None or not text:
                    continue
                words = words_of(text)
                if all(rule(words) for rule in rules):
                    out.append(doc)
            yield pa.record_batch([pa.array(out, pa.int64())], names=["doc_id"])

    return run


def found(documents: DataFrame) -> DataFrame:
    """``doc_id`` of the repetitive documents."""
    return documents.select("doc_id", "text").mapInArrow(_found(plan(documents)), "doc_id bigint").distinct()


def _shares(batches):
    names = [f.split()[0] for f in SHARES.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
    for b in batches:
        rows = []
        for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            if doc is None:
                continue
            words = words_of(text)
            n, again = len(words), repeated(words)
            lines = [x for x in map(str.strip, (text or "").split("\n")) if x]
            top = Counter(zip(words, words[1:], words[2:])).most_common(1) if n > 2 else []
            rows.append((doc, n, again, again / n if n else 0.0, 1 - len(set(lines)) / len(lines) if lines else 0.0, top[0][1] / (n - 2) if top else 0.0))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names=names)


def shares(documents: DataFrame) -> DataFrame:
    """Each document's share of repeated words, of repeated lines, and of its most frequent run of three words."""
    return documents.select("doc_id", "text").mapInArrow(_shares, SHARES).dropDuplicates(["doc_id"])
