import numpy as np

from foliant.llm import p5_quality as m
from foliant.llm.p5_seeds import seeds
from foliant.llm.rules import covers, induce, to_sql

COMMON = "the a of to and in for is that must may with by on or be not each any this when claim provider report".split()
SCHEMA = "section_id bigint, heading_text string, content_text string, word_count int, kind string"


def kinds(spark, rows):
    words = spark.createDataFrame([(w, i) for i, w in enumerate(COMMON, 1)], "word string, word_rank int")
    got = {}
    for r in m.found(spark.createDataFrame(rows, SCHEMA), words).collect():
        got.setdefault(r.section_id, set()).add(r.kind)
    return got


def test_verdicts_of_plain_cases(spark):
    prose = "The claim must be reviewed by the provider before the report is sent.\n" * 4
    rows = [
        (1, None, prose, None, "x"), (2, None, "\n".join(f"- annual report {w}" for w in COMMON[:12]), None, "x"), (3, None, "| a | b |\n| --- | --- |\n" + "\n".join(f"| claim {i} | {i} |" for i in range(9)), None, "x"),
        (4, None, " ".join(["zxcv", "qwrt", "pl", "bcdfg", "mnb"] * 9), None, "x"), (5, None, None, None, "x"), (6, None, "", None, "x"), (7, None, " \n\t ", None, "x"), (8, "One two", "three four.", 4, "x"), (9, "One two", "three four.", 5, "x"),
        (10, None, None, 3, "x"), (11, None, prose + "- one claim\n- two reports\n" + prose, None, "x"), (12, None, "Reserved", None, "x"), (4, None, " ".join(["zxcv", "qwrt", "pl", "bcdfg", "mnb"] * 9), None, "x"),
        (13, None, "word " * 100_000, None, "x"), (14, None, "Annual budget ........ 1\nFinal report ....... 3\nJoint clinic ...... 7\nLocal audit ....... 9\nPrior plan ....... 12\nUrgent panel ..... 14", None, "x"), (None, None, "x", 5, "x"),
    ]
    assert kinds(spark, rows) == {2: {"list"}, 3: {"table"}, 4: {"junk"}, 9: {"miscount"}, 10: {"miscount"}, 14: {"list"}}


def test_rules_hold_on_documents_they_have_not_seen():
    made = seeds(60, seed=99)
    known, common = m._Wordish(), frozenset(COMMON)
    x = np.array([m.features(t, common, known)[1:] for _, t in made])
    cols = {f: x[:, k] for k, f in enumerate(m.FEATURES)}
    got, left = np.array(["prose"] * len(made), dtype=object), np.ones(len(made), bool)
    for rule, name in m.rules(common):
        c = covers(rule, cols, len(made)) & left
        got[c], left = name, left & ~c
    assert (got == np.array([k for k, _ in made])).mean() > 0.95


def test_statistics_and_sql(spark):
    words = spark.createDataFrame([(w, i) for i, w in enumerate(COMMON, 1)], "word string, word_rank int")
    r = m.quality(spark.createDataFrame([(1, "A", "The claim.\n\nIt is so", 6, "k")], SCHEMA), words).collect()[0]
    assert (r.n_words, r.n_lines, r.mean_line_words, r.punct_share, r.trusted) == (5, 2.0, 2.5, 0.5, True) and abs(r.common_share - 3 / 5) < 1e-9
    assert to_sql([], "prose") == "'prose'" and to_sql([([("a", "<=", 1.0), ("b", ">", 2.0)], "x")], "y") == "CASE WHEN a <= 1.000000D AND b > 2.000000D THEN 'x' ELSE 'y' END"
    assert m.found(spark.createDataFrame([], SCHEMA), words).count() == 0


def test_induction_finds_a_threshold():
    r = np.random.default_rng(1)
    x = {"a": r.random(400), "b": r.random(400)}
    y = np.where((x["a"] > 0.7) & (x["b"] <= 0.4), "p", "q")
    rules = induce(x, y, ["p"])
    got = np.zeros(400, bool)
    for rule, _ in rules:
        got |= covers(rule, x, 400)
    assert (got == (y == "p")).mean() > 0.95
