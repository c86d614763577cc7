import re
from collections import defaultdict

from foliant.llm import p1_lines

SCHEMA = "collection_path string, sort_order int, content_text string, section_id bigint, source string, key string, line string"
LINE = "All rights in these tables remain with the council of {}"


def brute(rows):
    docs, at, sizes = defaultdict(set), defaultdict(set), defaultdict(set)
    for path, _, text, sid, *_ in rows:
        if path is None or sid is None:
            continue
        source = path.split(".")[1] if "." in path else path
        sizes[source].add(path)
        for no, line in enumerate((text or "").split("\n"), 1):
            k = re.sub(r"\d+", "0", " ".join(line.lower().split()))
            if sum(c.isalpha() for c in k) >= 20:
                docs[source, k].add(path)
                at[source, k].add((sid, no))
    return sorted({p for (s, k), d in docs.items() if len(d) >= 6 and len(d) * 20 >= len(sizes[s]) for p in at[s, k]})


def make():
    out = []
    for i in range(40):
        shown = (LINE.format("Marton") if i % 5 == 0 else LINE.format("MARTON").upper().replace(" ", "\xa0 ")) + f" {i}"
        text = "\n".join([shown if i % 4 else "Some other text of this one document here", "", f"This sentence is only in document number {chr(97 + i % 26) * 5}{chr(97 + i // 26) * 4}", "short line"])
        out.append((f"corpus.a.d{i}", 1, text, i, "x", "y", "z"))
    out += [("corpus.b.d1", 1, LINE.format("Marton"), 900, "x", "y", "z"), ("corpus.a.d1", 1, out[1][2], 1, "x", "y", "z")]
    return out + [("corpus.a.n", 1, None, 901, None, None, None), ("corpus.a.e", 1, "", 902, None, None, None), (None, 1, LINE.format("x"), 903, None, None, None), ("corpus.a.l", 1, "word " * 60_000, 904, None, None, None)]


def test_repeated_lines_equal_brute_force(spark, rows):
    data = make()
    assert rows(p1_lines.repeated_lines(spark.createDataFrame(data, SCHEMA))) == brute(data) != []


def test_clean_takes_out_those_lines_only(spark):
    data = make()
    bad = defaultdict(set)
    for sid, no in brute(data):
        bad[sid].add(no)
    got = {r.section_id: r for r in p1_lines.clean(spark.createDataFrame(data, SCHEMA), near=False).collect()}
    assert len(got) == len({r[3] for r in data})
    for _, _, text, sid, *_ in data:
        want = text if not bad[sid] else "\n".join(x for k, x in enumerate(text.split("\n"), 1) if k not in bad[sid])
        assert got[sid].content_text == want and got[sid].n_removed == len(bad[sid])


def test_clusters_hold_lines_that_differ_in_numbers_and_dates(spark):
    data = [(f"corpus.a.d{i}", 1, f"Transmittal {i}, issued 0{i % 9}-11-20, effective upon review of the archive", i, "", "", "") for i in range(8)]
    r = p1_lines.clusters_report(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(r) == 1 and r[0].docs == 8 and r[0].lines == 8


def test_near_duplicate_clusters_are_taken_out_whoever_is_named(spark):
    names = ["Anna Velde", "Omar Reyes", "Lucia Prentice", "Tom Aldous", "Ines Halloran", "Peter Quill", "Mara Ossian"]
    shown = [f"This page was written by {n} for the office of public records" for n in names] + ["Other words that are found in this one document only"]
    data = [(f"corpus.a.d{i}", 1, t + "\nA line that belongs to " + "abcdefgh"[i] * 9, i, "", "", "") for i, t in enumerate(shown)]
    df = spark.createDataFrame(data, SCHEMA)
    assert p1_lines.repeated_lines(df).count() == 0
    got = {r.section_id: r.n_removed for r in p1_lines.clean(df).collect()}
    assert got == {**{i: 1 for i in range(7)}, 7: 0}
    assert {r.n_removed for r in p1_lines.clean(df, near=False).collect()} == {0}
    r = p1_lines.clusters_report(df).collect()
    assert [tuple(x) for x in r] == [("a", "this page was written by # for the office of public records", 7, 7, 1)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert p1_lines.repeated_lines(empty).count() == p1_lines.clean(empty).count() == p1_lines.clusters_report(empty).count() == 0
