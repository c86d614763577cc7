"""Noise in text from scanned pages: broken words, misread characters, running headers and page numbers.

Words of the whole corpus are counted and grouped by their skeleton, in which glyphs that scanners confuse are the same
strokes. Within a group, a rare form that the confusions explain from a frequent one is a misreading of it; where several
frequent forms would do, the one that more often follows the preceding word is chosen. A word broken at a line end is joined if
the corpus knows the joined form better than the hyphenated one. Headers are lines without sentence form that, with digits
masked and by skeleton, return in the document's pages where the text is interrupted, or name the document's title. Page numbers
lie within the section's pages. Repaired text is reflowed over windows of the kept lines.

Sizes. The vocabulary, the misreadings and the counts of contexts stay distributed. Forms of a skeleton meet in a join that AQE may
split, the frequent ones on one side and those a few times rarer on the other. What is broadcast is a sieve: a Bloom filter of the
misread forms, of ``SIEVE_BITS`` bits (8 MB) at most. Words that pass it leave the one pass over the texts with the word before them,
and a join with the misreadings decides; more misreadings than the sieve has room for let more words pass and change nothing else.

What counts as evidence. A misread word differs in at most three characters, or half of them if that is more. Words of two or three
characters have too many neighbours: they count only if they mix letters with digits or ligatures and stand alone in a line of words. A header starts with a capital
or digit, does not end like a clause, and has 3 to 20 words and 14 to 140 characters, unless it is beside a page number: then
its length doesn't matter.

Defined cases: null, empty and blank texts have no noise and stay as they are; rows sent twice count once; sections
without pages have no page numbers; in one without an end they run on as long as each is at most ``OPEN_PAGES`` above
the one before; rows with a null section are left out.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import WORD, words_of
from foliant.runtime import materialize

#: Characters and how scanners misread them.
CONFUSED = [
    ("e", "c"), ("i", "1"), ("l", "1"), ("t", "f"), ("n", "ri"), ("o", "0"), ("d", "cl"), ("s", "5"), ("u", "ii"), ("m", "rn"),
    ("h", "b"), ("g", "9"), ("b", "6"), ("w", "vv"), ("fi", "ﬁ"), ("li", "h"), ("cl", "d"), ("rn", "m"),
]
#: Strokes of the characters above, so that each pair has the same.
STROKES = str.maketrans(
    {"m": "rrl", "n": "rl", "u": "ll", "d": "cl", "w": "vv", "h": "ll", "b": "ll", "6": "ll", "i": "l", "1": "l", "e": "c", "f": "t", "ﬁ": "tl", "0": "o", "5": "s", "9": "g"}
)
#: Marks that break a word at a line end.
MARKS = "-‐­¬"
OPEN_PAGES = 4
#: Bits of the sieve at most, and for each form.
SIEVE_BITS, SIEVE_EACH = 1 << 26, 32
#: Characters below which a misread word must mix letters with digits or ligatures.
SHORT = 4
#: A misreading is at least so many times rarer than the form it stands for.
RARER = 4
#: Strokes below which a key can't name a title, and is a header only if it is always beside a page number.
SHORT_TITLE = 14

_TOKEN = re.compile(r"[^\W_]+(?:-[^\W_]+)*-?")
_BROKEN = re.compile(rf"([^\W_]+)((?:-[^\W_]+)*)([{MARKS}])[^\S\n]*$")
_BREAK = re.compile(rf"[^\W_]+[{MARKS}][^\S\n]*\n\s*[^\W_]*")
_ENDS = re.compile(rf"[{MARKS}][^\S\n]*\n")
_PLAIN = {i: " " for i in range(128) if not chr(i).isalnum() and chr(i) != "-"}
_PAGE = re.compile(r"(?:[Pp]\.|[Pp]age|PAGE|[\[~(–-])?\s*([0-9lIOo]{1,5})\s*(?:[Oo][Ff]\s+[0-9lIOo]+|[\]~)–-])?")
_LETTER_DIGITS = str.maketrans("lIOo", "1100")
_NOT_LETTER = re.compile(r"[\W\d_]+")


def skeleton(word: str) -> str:
    return word.translate(STROKES)


_BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _pair in CONFUSED:
    _BY_FIRST.setdefault(_pair[0][0], []).append(_pair)


def misread(true: str, seen: str) -> int | None:
    """The fewest characters of ``true`` misread to give ``seen``; None if the confusions don't explain it."""
    n, m = len(true), len(seen)
    costs: list[dict[int, int]] = [{} for _ in range(n + 1)]
    costs[0][0] = 0
    for i in range(n):
        for j, c in costs[i].items():
            if j < m and true[i] == seen[j] and costs[i + 1].get(j + 1, c + 1) > c:
                costs[i + 1][j + 1] = c
            for a, b in _BY_FIRST.get(true[i], ()):
                if true.startswith(a, i) and seen.startswith(b, j) and costs[i + len(a)].get(j + len(b), c + 2) > c + 1:
                    costs[i + len(a)][j + len(b)] = c + 1
    return costs[n].get(m)


def explains(true: str, seen: str, most: int = 3) -> bool:
    """Whether ``seen`` is ``true`` with one to ``most`` characters misread, or up to half of them."""
    return 0 < (misread(true, seen) or 0) <= max(most, len(true) // 2)


def page_number(line: str) -> int | None:
    """The number of a line that holds only a printed page number."""
    m = _PAGE.fullmatch(line)
    if not m or len(m[1]) == 1 and not m[1].isdigit():
        return None
    return int(m[1].translate(_LETTER_DIGITS))


def title_key(text: str) -> str:
    """Letters of a line by skeleton, digits masked out."""
    return skeleton(_NOT_LETTER.sub("", text.lower()))


def _count_words(batches):
    def out(c: Counter):
        return pa.record_batch([pa.array(list(c.keys()), pa.string()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])

    counts: Counter = Counter()
    for b in batches:
        for text in b.column("content_text").to_pylist():
            text = text.lower()
            if _ENDS.search(text):
                text = _BREAK.sub("\n", text)
            # plain ASCII is split at once, and words with hyphens are taken apart when they are counted
            counts.update(text.translate(_PLAIN).split() if text.isascii() else _TOKEN.findall(text))
        if len(counts) > 300_000:
            yield out(_parts(counts))
            counts = Counter()
    yield out(_parts(counts))


def _parts(counts: Counter) -> Counter:
    """Hyphenated words count as such and with each part."""
    out: Counter = Counter()
    for run, n in counts.items():
        if "-" not in run:
            out[run] += n
            continue
        for w in _TOKEN.findall(run):
            out[w] += n
            if "-" in w:
                for part in w.strip("-").split("-"):
                    out[part] += n
    return out


def vocabulary(content: DataFrame) -> DataFrame:
    """``word, n`` of all words, of hyphenated words, and of words with a hanging hyphen (``pre-``)."""
    return content.where("content_text is not null").select("content_text").mapInArrow(_count_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _skeletons(batches):
    for b in batches:
        words = b.column("word").to_pylist()
        yield pa.record_batch([*b.columns, pa.array([skeleton(w) for w in words], pa.string())], names=["word", "n", "skeleton"])


def _explained(batches):
    for b in batches:
        keep = [explains(t, w) for t, w in zip(b.column("true").to_pylist(), b.column("seen").to_pylist())]
        yield b.filter(pa.array(keep, pa.bool_()))


def misreadings(words: DataFrame) -> DataFrame:
    """``seen, fixes``: rare forms and the frequent forms that they stand for, the most frequent first."""
    plain = words.where((F.length("word") >= 2) & ~F.contains("word", F.lit("-"))).mapInArrow(_skeletons, "word string, n bigint, skeleton string")
    own = F.col("word")
    odd = own.rlike(r"\p{Nd}|ﬁ")
    seen = plain.where((F.length("word") >= SHORT) | (odd & own.rlike(r"\p{L}"))).select("skeleton", own.alias("seen"), F.col("n").alias("k"), odd.alias("odd"))
    true = plain.where((F.col("n") >= 2) & ~own.rlike(r"[^\p{L}]|ﬁ")).select("skeleton", own.alias("true"), "n")
    often = ((F.col("n") >= RARER * F.col("k")) & (F.col("n") >= 3)) | (F.col("odd") & (F.col("n") > F.col("k")) & (F.length("seen") >= SHORT))
    # a misread character adds or takes away one character at most
    near = F.abs(F.length("true") - F.length("seen")) <= F.greatest(F.lit(3), F.length("true") / 2)
    fits = seen.join(true, "skeleton").where(often & near & (F.col("true") != F.col("seen"))).select("seen", "true", "n").mapInArrow(_explained, "seen string, true string, n bigint")
    each = fits.groupBy("seen").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("r"), F.col("true")))).alias("f"))
    kept = F.filter("f", lambda x: x["r"] * 20 <= F.element_at("f", 1)["r"])
    return each.select("seen", F.transform(kept, lambda x: x["true"]).alias("fixes"))


class Sieve:
    """A Bloom filter of words; words that are not of it may pass. It remembers its answers within a bound."""

    REMEMBERED = 400_000

    def __init__(self, bits: np.ndarray):
        self.bits, self.asked, self.passed = bits, set(), set()

    def of(self, words: set[str]) -> set[str]:
        """Those that pass."""
        if len(self.asked) >= self.REMEMBERED:
            self.asked, self.passed = set(), set()
        last = len(self.bits) * 64 - 1
        for w in words - self.asked:
            if all(int(self.bits[p >> 6]) >> (p & 63) & 1 for p in places(w, last)):
                self.passed.add(w)
        self.asked |= words
        return words & self.passed

    def __reduce__(self):
        return Sieve, (self.bits,)


def places(w: str, last: int) -> tuple[int, int, int, int]:
    """The four bits of a word, by double hashing."""
    import xxhash

    h = xxhash.xxh64_intdigest(w)
    a, b = h & 0xFFFFFFFF, h >> 32 | 1
    return a & last, (a + b) & last, (a + 2 * b) & last, (a + 3 * b) & last


def sieve(words: DataFrame, column: str) -> Sieve:
    """The sieve of a column's words: bits are set in Spark, and at most ``SIEVE_BITS`` of them come to the driver as whole numbers of 64."""
    size = min(SIEVE_BITS, 1 << max(10, int(SIEVE_EACH * words.count()).bit_length()))

    def bits(batches):
        for b in batches:
            at = np.array([p for w in b.column(0).to_pylist() for p in places(w, size - 1)], np.int64)
            cell, inverse = np.unique(at >> 6, return_inverse=True)
            mask = np.zeros(len(cell), np.uint64)
            np.bitwise_or.at(mask, inverse, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.record_batch([pa.array(cell), pa.array(mask.view(np.int64))], names=["cell", "mask"])

    t = words.select(column).mapInArrow(bits, "cell bigint, mask bigint").groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()
    own = np.zeros(size // 64, np.uint64)
    own[t.column("cell").to_numpy()] = t.column("mask").to_numpy().view(np.uint64)
    return Sieve(own)


def _contexts(shared):
    def run(batches):
        wanted, counts = shared.value, Counter()

        def out():
            return pa.record_batch([pa.array([p for p, _ in counts], pa.string()), pa.array([w for _, w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["before", "word", "n"])

        for b in batches:
            for text in b.column("content_text").to_pylist():
                ws = words_of(text)
                known = wanted.of(set(ws))
                if known:
                    counts.update((p, w) for p, w in zip(ws, ws[1:]) if w in known)
            if len(counts) > 200_000:
                yield out()
                counts = Counter()
        yield out()

    return run


CANDIDATES = "section_id bigint, path string, line_no int, what string, x string, y string, z string, near boolean, broken boolean"


def _title_form(s: str) -> bool:
    return (s[0].isupper() or s[0].isdigit()) and s[-1] not in ",;:!?" and "|" not in s and "\t" not in s


def _title_like(s: str, n_words: int) -> bool:
    return 3 <= n_words <= 20 and 14 <= len(s) <= 140 and _title_form(s)


def _stands_alone(w: str, line: str) -> bool:
    """Whether a line of several words has the word by itself, but for marks around it."""
    ws = line.split()
    return len(ws) > 2 and any(x.strip(".,;:!?()[]\"'") == w for x in ws)


def section_noise(text: str, first: int | None, last: int | None, fixes: dict[str, list[str]] | Sieve, context: dict[tuple[str, str], int] | None = None) -> list[tuple]:
    """``line_no, what, x, y, z, near, broken`` of what may be noise in one section.

    ``pageno``; ``hyphen?`` with the joined and hyphenated form and the hanging one; ``title?`` with its key and whether it is beside a page number
    or interrupts the text; ``char`` with the word and its repair; by a sieve, ``char?`` with the word, its lower-case form and the word before.
    """
    lines = [x.strip() for x in text.split("\n")]
    full = [i for i, x in enumerate(lines) if x]
    out: list[tuple] = []
    pages = set()
    if first is not None:
        top = first
        for i in full:
            n = page_number(lines[i])
            if n is not None and first <= n and (n <= last if last is not None else n <= top + OPEN_PAGES):
                top = max(top, n)
                pages.add(i)
                out.append((i + 1, "pageno", str(n), None, None, False, False))
    titles = set()
    place = {i: k for k, i in enumerate(full)}
    solid = [i for i in full if i not in pages]
    alike = {}
    for k, i in enumerate(solid):
        s = lines[i]
        n_words = len(s.split())
        alike[i] = like = _title_like(s, n_words)
        at = place[i]
        beside = {i - 1, i + 1} & pages or {full[at - 1] if at else -1, full[at + 1] if at + 1 < len(full) else -1} & pages
        if not like and not (beside and _title_form(s)):
            continue
        before = lines[solid[k - 1]] if k else ""
        after = lines[solid[k + 1]] if k + 1 < len(solid) else ""
        # the text before has not ended, or the text after goes on in the middle of a sentence
        broken = bool(before and before[-1] not in ".!?:;\"')" and not (before.isupper() and not s.isupper())) or bool(after and after[0].islower())
        if beside or broken or k == 0 or s.isupper() or s.startswith(("Chapter", "CHAPTER")):
            out.append((i + 1, "title?", title_key(s), None, None, bool(beside), broken))
            if like and (beside or broken):
                titles.add(i)
    parts: dict[int, list[bool]] = {}
    # the next line that goes on with a word broken above it, or shows that none does: for words in capitals a line in capitals may
    low = cap = -1
    nexts = {}
    for k in range(len(solid) - 1, -1, -1) if any(lines[i][-1] in MARKS for i in solid) else ():
        i = solid[k]
        if lines[i][-1] in MARKS:
            nexts[k] = (low, cap)
        letters, word = any(c.isalpha() for c in lines[i]), WORD.match(lines[i])
        if word and lines[i][0].islower():
            low = cap = i
        elif letters and not alike[i]:
            low = cap = i
        elif word and lines[i][0].isupper() and i not in titles:
            cap = i
    for k, i in enumerate(solid):
        if k not in nexts:
            continue
        m = _BROKEN.search(lines[i])
        if not m:
            continue
        head = (m[1] + m[2]).split("-")[-1]
        j = nexts[k][1 if head.isupper() else 0]
        tail = WORD.match(lines[j]) if j >= 0 else None
        if tail and (lines[j][0].islower() or head.isupper() and lines[j][0].isupper() and j not in titles):
            joined = (head + tail[0]).lower()
            whole = re.match(r"[^\W_]+(?:-[^\W_]+)*", lines[j])[0]
            out.append((i + 1, "hyphen?", joined, f"{m[1]}{m[2]}-{whole}".lower(), f"{head}-".lower(), m[3] != "-", False))
            parts.setdefault(i, [False, False])[1] = True
            parts.setdefault(j, [False, False])[0] = True
    sieved = isinstance(fixes, Sieve)
    asked = fixes.of(set(words_of(text))) if sieved else fixes
    for i in solid if asked else ():
        ws = WORD.findall(lines[i])
        own = parts.get(i, (False, False))
        for k, w in enumerate(ws):
            low_ = w.lower()
            if low_ in asked and not (own[0] and k == 0) and not (own[1] and k == len(ws) - 1) and (len(w) >= SHORT or _stands_alone(w, lines[i])):
                before = ws[k - 1].lower() if k else ""
                if sieved:
                    out.append((i + 1, "char?", w, low_, before, False, False))
                    continue
                to = sorted(fixes[low_], key=lambda f: -(context or {}).get((before, f), 0))[0]
                out.append((i + 1, "char", w, to.upper() if w.isupper() else to.capitalize() if w[0].isupper() else to, None, False, False))
    return out


def _candidates(shared):
    types = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]
    names = [f.split()[0] for f in CANDIDATES.split(", ")]

    def run(batches):
        fixes = shared.value
        for b in batches:
            rows = []
            for sid, path, text, first, last in zip(*(b.column(c).to_pylist() for c in ("section_id", "collection_path", "content_text", "page_start", "page_end"))):
                rows += [(sid, path, *r) for r in section_noise(text, first, last, fixes)]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names=names)

    return run


def candidates(content: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates of every section (:data:`CANDIDATES`), misreadings already looked up."""
    spark = content.sparkSession
    fixes = materialize(misreadings(words), "p6-fixes")
    texts = content.where("content_text is not null and section_id is not null").select("section_id", "collection_path", "content_text", "page_start", "page_end")
    found = materialize(texts.mapInArrow(_candidates(spark.sparkContext.broadcast(sieve(fixes, "seen"))), CANDIDATES), "p6-candidates")
    open_ = materialize(fixes.where("size(fixes) > 1").select(F.explode("fixes").alias("word")).distinct(), "p6-open")
    near = spark.createDataFrame([], "before string, word string, n bigint")
    if not open_.isEmpty():
        near = texts.select("content_text").mapInArrow(_contexts(spark.sparkContext.broadcast(sieve(open_, "word"))), "before string, word string, n bigint").join(open_, "word", "left_semi").groupBy("before", "word").agg(F.sum("n").alias("n"))
    asked = found.where("what = 'char?'").join(fixes.withColumnRenamed("seen", "y"), "y").drop("y")
    return found.where("what <> 'char?'").unionByName(chosen(asked, near))


def chosen(asked: DataFrame, near: DataFrame) -> DataFrame:
    """Words with their ``fixes`` as ``char``: the repair that most often follows the word before (``z``), of equal ones the most frequent form."""
    keys = ["section_id", "path", "line_no", "x", "z"]
    first = F.substring("x", 1, 1)
    cased = F.when((F.upper("x") == F.col("x")) & (F.lower("x") != F.col("x")), F.upper("fix")).when(F.lower(first) != first, F.initcap("fix")).otherwise(F.col("fix"))
    no, none = F.lit(False), F.lit(None).cast("string")
    shown = lambda d: d.select("section_id", "path", "line_no", F.lit("char").alias("what"), "x", cased.alias("y"), none.alias("z"), no.alias("near"), no.alias("broken"))
    one = asked.where("size(fixes) = 1").select(*keys, F.col("fixes")[0].alias("fix"))
    each = asked.where("size(fixes) > 1").select(*keys, "fixes").distinct().select(*keys, F.posexplode("fixes").alias("pos", "word"))
    counted = each.join(near.withColumnRenamed("before", "z"), ["z", "word"], "left")
    best = counted.groupBy(*keys).agg(F.max(F.struct(F.coalesce("n", F.lit(0)).alias("n"), (-F.col("pos")).alias("pos"), "word"))["word"].alias("fix"))
    return shown(one).unionByName(shown(best))


def hyphens(found: DataFrame, words: DataFrame) -> DataFrame:
    """Broken words: ``section_id, line_no, joined`` where the corpus speaks for the joined form."""
    asked = found.where("what = 'hyphen?'").select("section_id", "line_no", F.col("near").alias("clear"), "x", F.explode(F.create_map(F.lit("x"), F.col("x"), F.lit("y"), F.col("y"), F.lit("z"), F.col("z"))).alias("role", "word"))
    seen = asked.join(words, "word", "left").groupBy("section_id", "line_no").agg(
        F.first("x").alias("joined"), F.first("clear").alias("clear"), *[F.coalesce(F.max(F.when(F.col("role") == r, F.col("n"))), F.lit(0)).alias(r) for r in "xyz"]
    )
    # joined, hyphenated and hanging form in the corpus; an unknown word is joined unless a form with its mark is known
    known = (F.col("x") > F.col("y")) & ((F.col("x") > 1) | (F.col("z") == 0))
    return seen.where(known | ((F.col("x") == 0) & (F.col("y") == 0) & ((F.col("z") == 0) | F.col("clear")))).select("section_id", "line_no", "joined")


def headers(found: DataFrame, document: DataFrame) -> DataFrame:
    """``section_id, line_no`` of running headers."""
    lines = found.where("what = 'title?'").select("section_id", "path", "line_no", F.col("x").alias("key"), "near", "broken").distinct()
    by_doc = lines.groupBy("path", "key").agg(F.count("*").alias("times"), F.count_if("near").alias("n_near"), F.count_if(F.col("near") | F.col("broken")).alias("n_signs"))
    titles = document.where("title is not null").mapInArrow(_titles, "path string, whole string, tail string").where(F.length("tail") >= SHORT_TITLE).groupBy("path").agg(F.collect_set("whole").alias("wholes"), F.collect_set("tail").alias("tails"))
    said = by_doc.join(titles, "path", "left")
    named = (F.length("key") >= SHORT_TITLE) & (F.exists("wholes", lambda t: F.contains(t, F.col("key"))) | F.exists("tails", lambda t: F.contains(F.col("key"), t)))
    # the evidence lies within the document, so a header that many documents share counts in each
    again = (F.length("key") > 0) & (F.col("times") >= 2) & F.when(F.length("key") >= SHORT_TITLE, F.col("n_near") * 4 >= F.col("times")).otherwise(F.col("n_near") == F.col("times"))
    good = said.where(F.coalesce(named, F.lit(False)) | again).select("path", "key")
    return lines.join(good, ["path", "key"], "left_semi").select("section_id", "line_no").distinct()


def _titles(batches):
    for b in batches:
        paths, titles = b.column("collection_path").to_pylist(), b.column("title").to_pylist()
        yield pa.record_batch(
            [pa.array(paths, pa.string()), pa.array([title_key(t) for t in titles], pa.string()), pa.array([title_key(re.split(r" - |: ", t)[-1]) for t in titles], pa.string())],
            names=["path", "whole", "tail"],
        )


def noise(content: DataFrame, document: DataFrame) -> DataFrame:
    """``section_id, line_no, kind, word, fix``: every piece of noise, misreadings word by word."""
    words = materialize(vocabulary(content), "p6-words")
    found = candidates(content, words)
    head = materialize(headers(found, document), "p6-headers")
    cut = hyphens(found, words).join(head, ["section_id", "line_no"], "left_anti").select("section_id", "line_no", F.lit("hyphen").alias("kind"), F.lit(None).cast("string").alias("word"), F.col("joined").alias("fix"))
    page = found.where("what = 'pageno'").select("section_id", "line_no", F.lit("pageno").alias("kind"), F.lit(None).cast("string").alias("word"), F.lit(None).cast("string").alias("fix"))
    char = found.where("what = 'char'").join(head, ["section_id", "line_no"], "left_anti").select("section_id", "line_no", F.lit("char").alias("kind"), F.col("x").alias("word"), F.col("y").alias("fix"))
    top = head.select("section_id", "line_no", F.lit("header").alias("kind"), F.lit(None).cast("string").alias("word"), F.lit(None).cast("string").alias("fix"))
    return cut.unionByName(page).unionByName(char).unionByName(top).distinct()


def found(content: DataFrame, document: DataFrame) -> DataFrame:
    """``section_id, line_no, kind``."""
    return noise(content, document).select("section_id", "line_no", "kind").distinct()


def repaired(content: DataFrame, document: DataFrame) -> DataFrame:
    """The same sections as continuous paragraphs: ``section_id, content_text, n_repairs``; sections without noise keep their text."""
    bad = materialize(noise(content, document), "p6-noise")
    one = content.where("section_id is not null").select("section_id", "content_text").dropDuplicates(["section_id"])
    per_line = bad.groupBy("section_id", "line_no").agg(
        F.bool_or(F.col("kind").isin("header", "pageno")).alias("drop"), F.bool_or(F.col("kind") == "hyphen").alias("cut"), F.collect_set(F.when(F.col("kind") == "char", F.struct("word", "fix"))).alias("fixes"), F.count("*").alias("n")
    )
    noisy = bad.select("section_id").distinct()
    lines = one.join(noisy, "section_id", "left_semi").select("section_id", F.posexplode(F.split("content_text", "\n")).alias("pos", "line")).withColumn("line_no", F.col("pos") + 1)
    fixed = F.aggregate("fixes", F.trim(F.regexp_replace("line", r"\s+", " ")), lambda s, f: F.regexp_replace(s, F.concat(F.lit(r"(?<![\p{L}\p{N}])"), f["word"], F.lit(r"(?![\p{L}\p{N}])")), f["fix"]))
    kept = lines.join(per_line, ["section_id", "line_no"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    w = Window.partitionBy("section_id").orderBy("line_no")
    shown = (
        kept.withColumn("text", F.when(F.coalesce("drop", F.lit(False)), F.lit(None)).when(F.size("fixes") > 0, fixed).otherwise(F.trim(F.regexp_replace("line", r"\s+", " "))))
        # a removed line and the blank lines around it don't end a paragraph
        .where("text is not null")
        .withColumn("before_cut", F.coalesce(F.lag("cut").over(w), F.lit(False)))
        .withColumn("before_blank", F.coalesce(F.lag("text").over(w) == "", F.lit(True)))
        .withColumn("body", F.when(F.coalesce("cut", F.lit(False)), F.regexp_replace("text", rf"[{MARKS}]\z", "")).otherwise(F.col("text")))
        .withColumn("piece", F.when(F.col("text") == "", F.lit("\n\n")).when(F.col("before_cut") | F.col("before_blank"), F.col("body")).otherwise(F.concat(F.lit(" "), F.col("body"))))
    )
    text = shown.groupBy("section_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "piece"))).alias("p"))
    flat = F.trim(F.regexp_replace(F.array_join(F.transform("p", lambda x: x["piece"]), ""), r"\n{3,}", "\n\n"))
    total = per_line.groupBy("section_id").agg(F.sum("n").alias("n_repairs"))
    return one.join(text.select("section_id", flat.alias("new")), "section_id", "left").join(total, "section_id", "left").select("section_id", F.coalesce("new", "content_text").alias("content_text"), F.coalesce("n_repairs", F.lit(0)).alias("n_repairs"))
