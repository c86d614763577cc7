import random

import numpy as np

from foliant.llm import p4_near as m
from foliant.llm.common import WordHash, words_of

WORDS = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in "rstlmn"]


def text(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def edit(r, t, n):
    ws = t.split()
    for _ in range(n):
        i = r.randrange(len(ws))
        r.choice([lambda: ws.insert(i, r.choice(WORDS)), lambda: ws.pop(i), lambda: ws.__setitem__(i, r.choice(WORDS))])()
    return " ".join(ws)


def make():
    r, out = random.Random(8), []
    for k in range(60):
        base = text(r, r.randint(40, 200))
        out += [(10 * k + j, base if not j else edit(r, base, r.randint(1, 12))) for j in range(r.randint(1, 4))]
    half = text(r, 80).split()
    out += [(1000, " ".join(half)), (1001, " ".join(half[40:] + half[:40])), (1002, " ".join(half).upper() + "!"), (1003, " ".join(half))]
    out += [(2000, None), (2001, ""), (2002, text(r, 10)), (2003, "same word " * 30), (2004, "same word " * 40), (0, out[0][1])]
    return out


def brute(rows):
    own = {i: words_of(t) for i, t in rows if t is not None and len(words_of(t)) >= 20}
    ids = sorted(own)
    return [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if m.similarity(own[a], own[b]) >= 0.5]


def frames(spark, data):
    content = spark.createDataFrame([(i, t, "c") for i, t in data], "section_id bigint, content_text string, class string")
    chunks = spark.createDataFrame([(i, t, 5) for i, t in data[:40]], "chunk_id bigint, chunk_text string, a int")
    return content, chunks


def test_pairs_equal_brute_force(spark):
    data = make()
    got = m.pairs(*frames(spark, data)).collect()
    assert len(got) == len(set(got))
    for name, own in (("document_content", data), ("embedding_table", data[:40])):
        found, want, text_of = {(r.id_a, r.id_b) for r in got if r.table_name == name}, set(brute(own)), dict(own)
        assert found <= want and len(found) >= 0.98 * len(want)
        # what the samples may miss lies near the threshold
        assert all(m.similarity(words_of(text_of[a]), words_of(text_of[b])) < 0.6 for a, b in want - found)


def test_large_classes_become_stars(spark, monkeypatch):
    monkeypatch.setattr(m, "EXPANDED", 3)
    r = random.Random(9)
    base = text(r, 60)
    data = [(i, base) for i in range(8)] + [(20, edit(r, base, 2))]
    got = {(x.id_a, x.id_b) for x in m.pairs(*frames(spark, data)).collect() if x.table_name == "document_content"}
    assert got == {(0, i) for i in range(1, 8)} | {(0, 20)}


def test_large_classes_as_pairs(spark, monkeypatch):
    monkeypatch.setattr(m, "EXPANDED", 3)
    r = random.Random(9)
    base = text(r, 60)
    data = [(i, base) for i in range(8)] + [(20, edit(r, base, 2))]
    got = {(x.id_a, x.id_b) for x in m.pairs(*frames(spark, data), all_pairs=True).collect() if x.table_name == "document_content"}
    assert got == {(i, j) for i in range(8) for j in [*range(i + 1, 8), 20]}


def test_bound_is_never_too_low():
    r, k = random.Random(3), WordHash()
    for _ in range(200):
        a = text(r, r.choice([20, 60, 300, 900]))
        b = edit(r, a, r.randint(0, 60)) if r.random() < 0.7 else text(r, 80)
        x, y = (m.kmers(words_of(t), k) for t in (a, b))
        x, y = (h if again is None else h[~again] for h, again in (x, y))
        maps = [np.frombuffer(m.bitmap(h), np.uint8)[None, :] for h in (x, y)]
        both = len(set(x.tolist()) & set(y.tolist()))
        assert m.most_shared(*maps, np.array([len(x)]), np.array([len(y)]))[0] >= both
        assert m.aligned(x.tolist(), y.tolist()) <= both
    # and near enough to reject texts that share little
    a, b = (m.kmers(text(r, 250).split(), k)[0] for _ in range(2))
    maps = [np.frombuffer(m.bitmap(h), np.uint8)[None, :] for h in (a, b)]
    assert not m.enough(m.most_shared(*maps, np.array([len(a)]), np.array([len(b)]))[0], len(a), len(b))


def test_alignment_decides_how_a_pair_is_verified(spark, monkeypatch):
    r = random.Random(4)
    base = text(r, 120).split()
    data = [(1, " ".join(base)), (2, edit(r, " ".join(base), 3)), (3, " ".join(base[70:] + base[:70]))]
    how = lambda: {(x.id_a, x.id_b): x.how for x in m.links(*frames(spark, data)).collect() if x.table_name == "document_content"}
    assert how() == {(1, 2): "aligned", (1, 3): "moved", (2, 3): "moved"}
    monkeypatch.setattr(m, "aligned", lambda *_: 0)
    assert set(how().values()) == {"moved"}


def test_groups_connect_what_is_linked(spark):
    data = make()
    got = [r for r in m.groups(*frames(spark, data)).collect() if r.table_name == "document_content"]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in brute(data):
        root[find(b)] = find(a)
    want, have = {}, {}
    for x in list(root):
        want.setdefault(find(x), set()).add(x)
    for r in got:
        have.setdefault(r.group_id, set()).add(r.id)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values()))
    assert len(got) == len({r.id for r in got})


def test_alignment_and_sketch():
    a = text(random.Random(1), 100).split()
    assert m.alignment(a, a) == 1.0 and m.alignment(a, []) == 0.0 and 0.97 < m.alignment(a, a[:50] + ["x"] + a[50:]) < 1
    assert m.alignment(a, a[50:] + a[:50], band=10) < 0.3
    k = WordHash()
    one, two = m.sketch(*m.kmers(a, k)), m.sketch(*m.kmers(a[50:] + a[:50], k))
    assert (one == m.sketch(*m.kmers(a, WordHash()))).all()
    assert (one[m.IN_ORDER :] == two[m.IN_ORDER :]).sum() > 20 > (one[: m.IN_ORDER] == two[: m.IN_ORDER]).sum()
    again = ["a", "b", "c", "d"] * 3
    h, seen = m.kmers(again, k)
    assert len(set(h.tolist())) == len(again) - 2 and seen.sum() == len(again) - 2 - 4
    few, more = (m.sketch(*m.kmers(["same", "word"] * n, k)) for n in (15, 40))
    assert (few[m.IN_ORDER :] == more[m.IN_ORDER :]).all() and len(set(few.tolist())) == m.SKETCHES


def test_components_of_a_chain(spark, rows):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101)], "a bigint, b bigint")
    assert rows(m.components(edges)) == sorted([(i, 1) for i in range(1, 41)] + [(100, 100), (101, 100)])


def test_components_of_shuffled_chains(spark, rows):
    r = random.Random(5)
    ids = [r.getrandbits(63) - 2**62 for _ in range(900)]
    chains = [ids[:400], ids[400:800], ids[800:]]
    links = [(min(a, b), max(a, b)) for c in chains for a, b in zip(c, c[1:])]
    r.shuffle(links)
    assert rows(m.components(spark.createDataFrame(links, "a bigint, b bigint"))) == sorted((x, min(c)) for c in chains for x in c)


def test_empty_tables(spark):
    content, chunks = frames(spark, [(1, "x")])
    assert m.pairs(content.where("false"), chunks.where("false")).count() == m.groups(content.where("false"), chunks.where("false")).count() == 0
