import random

from foliant.llm import p8_leaks as m
from foliant.llm.common import words_of

ITEM = "On February 2 the Esteriwell clinic accepted a quarterly statute of Rosowlyn and the observation for 31,421.95 dollars in all"


def brute(docs, items, n=12):
    out = set()
    for d, t in docs:
        w = words_of(t)
        own = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        for i, x in items:
            v = words_of(x)
            if any(tuple(v[k : k + n]) in own for k in range(len(v) - n + 1)):
                out.add((d, i))
    return sorted(out)


def data():
    r = random.Random(2)
    filler = lambda n: " ".join(r.choice(ITEM.lower().split()) for _ in range(n))
    items = [(1, ITEM), (2, ITEM + " and more words that follow it here"), (3, "too short"), (4, None), (5, "")]
    ws = ITEM.split()
    docs = [(1, "Before. " + ITEM.upper().replace(" ", "\n-- ") + " after"), (2, "x " + " ".join(ws[:12]) + " y"), (3, " ".join(ws[:11]) + " y"), (4, None), (5, ""), (6, filler(400)), (7, " ".join(reversed(ws))), (8, "z " * 30_000 + ITEM), (1, "Before. " + ITEM.upper().replace(" ", "\n-- ") + " after")]
    return docs, items


def frames(spark):
    docs, items = data()
    return spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id bigint, text string, item_id int"), spark.createDataFrame([(i, t, "s") for i, t in items], "item_id bigint, text string, subject string")


def test_leaks_equal_brute_force(spark, rows):
    docs, items = data()
    assert rows(m.leaks(spark, *frames(spark))) == brute(docs, items)


def test_items_in_blocks_give_the_same(spark, rows, monkeypatch):
    whole = rows(m.leaks(spark, *frames(spark)))
    assert len(list(m.blocks(frames(spark)[1], limit=25))) == 3
    monkeypatch.setattr(m.blocks, "__defaults__", (12, 25))
    assert rows(m.leaks(spark, *frames(spark))) == whole


def test_spans_are_cut_out(spark):
    docs, items = frames(spark)
    got = {r.doc_id: r for r in m.clean(spark, docs.dropDuplicates(["doc_id"]), items, drop_share=2.0).collect()}
    assert got[2].text == "x  y" and got[3].n_removed == 0 and got[4].text is None and got[5].text == "" and got[1].text == "Before.  after".replace("  ", " " + " ")
    assert 2 not in {r.doc_id for r in m.clean(spark, docs, items, drop_share=0.5).collect()}
    assert got[8].text == "z " * 30_000


def test_spans_are_places_in_the_text_as_it_is(spark):
    words = [f"word{i}" for i in range(14)]
    texts = ["İstanbul İzmir İnegöl " + " ".join(words) + " tail end here", "ΑΣ.Α İ " + " ".join(words), "İ" * 30 + " " + " ".join(words).upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(words), "s")], "item_id bigint, text string, subject string")
    got = {r.doc_id: r for r in m.leak_spans(spark, docs, items).collect()}
    for i, t in enumerate(texts):
        assert t[got[i].start_char : got[i].end_char].lower() == " ".join(words)
    assert (got[0].first_word, got[0].last_word) == (3, 16)
    clean = {r.doc_id: r.text for r in m.clean(spark, docs, items, drop_share=2.0).collect()}
    assert clean == {0: "İstanbul İzmir İnegöl  tail end here", 1: "ΑΣ.Α İ ", 2: "İ" * 30 + " "}


def test_the_broadcast_is_compact():
    items = [(i, f"a{i} b c d e f g h i j k l m n {i}".split()) for i in range(2000)]
    import pickle

    assert len(pickle.dumps(m.Grams(items, 12))) < 24 * 15 * 2000


def test_empty(spark):
    docs, items = frames(spark)
    assert m.leaks(spark, docs.where("false"), items).count() == m.leaks(spark, docs, items.where("false")).count() == 0
