import itertools

from hypothesis import given, settings
from hypothesis import strategies as st

from foliant.llm import p9_repeats as m
from foliant.llm.common import words_of

WORDS = st.lists(st.sampled_from("abcdef"), max_size=60)


def brute(words, run=5):
    covered, n = set(), len(words)
    for i in range(n - run + 1):
        if any(words[j : j + run] == words[i : i + run] for j in range(i)):
            covered |= set(range(i, i + run))
    return len(covered)


@settings(max_examples=300, deadline=None)
@given(WORDS)
def test_repeated_equals_brute_force_and_rules_are_necessary(words):
    assert m.repeated(words) == brute(words)
    if len(words) >= 20 and brute(words) * 100 >= 30 * len(words):
        assert all(rule(words) for rule in m.RULES.values())


def test_found_whatever_the_order(spark, rows, monkeypatch):
    texts = ["one two three four five six seven. " * 6, "a b c d e " * 3, "unique words only " + " ".join(f"w{i}" for i in range(80)), None, "", "Same Line of text here\n" * 10, "x " * 50_000]
    df = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)] + [(0, texts[0], 0.5), (None, texts[0], 0.5)], "doc_id bigint, text string, share double")
    want = [(i,) for i, t in enumerate(texts) if t and len(words_of(t)) >= 20 and brute(words_of(t)[:3000]) >= 0.3 * len(words_of(t)[:3000])]
    assert rows(m.found(df)) == want == [(0,), (5,), (6,)]
    for order in itertools.permutations(m.RULES):
        assert [d for b in m._found(list(order))(df.select("doc_id", "text").limit(6).toArrow().to_batches()) for d in b.column("doc_id").to_pylist()] == [0, 5]


def test_shares(spark):
    df = spark.createDataFrame([(1, "a b c d e f " * 4), (2, None), (3, "")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in m.shares(df).collect()}
    assert (got[1].n_words, got[1].repeated_words, got[1].share) == (24, 18, 0.75) and got[2].share == got[3].share == 0.0
    assert m.found(df.where("false")).count() == m.shares(df.where("false")).count() == 0


def test_order_of_rules_follows_rejection_per_cost():
    assert set(m.order_rules(["a b c"] * 50)) == set(m.RULES) and m.order_rules(["x"] * 200)[0] == "length"
