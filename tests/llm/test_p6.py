from foliant.llm import p6_scans as m

CONTENT = "section_id bigint, collection_path string, content_text string, page_start int, page_end int, kind string"
DOCS = "collection_path string, title string"
BODY = "The annual enrollment of the provider must be certified by the council before the risk-adjusted payment is made."


def frames(spark):
    scan = "\n".join(
        ["Chapter 4 - Annual review of the Marton", "The annual enroll-", "[71]", "CHAPTER 4 - ANNUAL REVIEW OF THE MARTON", "ment of the providcr must be certified by the c0uncil before the risk-", "adjusted payment is made. The pre- and post-payment audit is made by the coun¬", "cil of the", "1950", "annual payment.", "", "Page 72 of 90", "The council must be certified."]
    )
    rows = [(1, "c.s.d1", scan, 71, 73, "k"), (1, "c.s.d1", scan, 71, 73, "k"), (2, "c.s.d1", None, 1, 1, "k"), (3, "c.s.d1", "", None, None, "k"), (4, "c.s.d2", BODY + "\n72\nThe pre- and post-payment audit", None, None, "k")]
    rows += [(10 + i, f"c.s.x{i}", BODY + " The pre- and post-payment audit is made.", 1, 2, "k") for i in range(12)]
    return spark.createDataFrame(rows, CONTENT), spark.createDataFrame([("c.s.d1", "Volume 3: Joint Panel, Chapter 4 - Annual review of the Marton"), ("c.s.d2", None)], DOCS)


def test_found(spark, rows):
    assert rows(m.found(*frames(spark))) == sorted(
        [(1, 1, "header"), (1, 2, "hyphen"), (1, 3, "pageno"), (1, 4, "header"), (1, 5, "char"), (1, 6, "hyphen"), (1, 11, "pageno")]
    )


def test_repaired(spark):
    got = {r.section_id: r.content_text for r in m.repaired(*frames(spark)).collect()}
    assert got[1].startswith("The annual enrollment of the provider must be certified by the council before the risk- adjusted") or got[1].startswith("The annual enrollment of the provider must be certified by the council before the risk-")
    assert "[71]" not in got[1] and "Chapter" not in got[1] and "council of the 1950 annual payment." in got[1] and got[1].endswith("\n\nThe council must be certified.")
    assert got[2] is None and got[3] == "" and got[4].endswith("audit") and len(got) == 16


def test_helpers():
    for true, seen in (("initial", "iriitial"), ("document", "docurnent"), ("therapy", "fherapy"), ("claim", "daim"), ("licensed", "hcensed"), ("waiver", "vvaiver"), ("benefit", "beneﬁt")):
        assert m.explains(true, seen) and m.skeleton(true) == m.skeleton(seen)
    assert not m.explains("form", "farm") and not m.explains("form", "form")
    assert [m.page_number(x) for x in ("Page lO4 of 980", "[9O]", "~l8~", "- 110 -", "p. 95", "12", "Oil", "A 12", "I", "90,396")] == [104, 90, 18, 110, 95, 12, None, None, None, None]


def test_context_chooses_between_fixes():
    fixes, context = {"rnodem": ["modern", "modem"]}, {("a", "modem"): 9, ("the", "modern"): 4}
    out = m.section_noise("Use a rnodem in the rnodem house today.", None, None, fixes, context)
    assert [(r[2], r[3]) for r in out if r[1] == "char"] == [("rnodem", "modem"), ("rnodem", "modern")]


def test_header_parted_from_its_page_number_in_a_long_section():
    for n in (10, 80):
        body = [f"The provider is paid in month {i}." for i in range(n)]
        out = m.section_noise("\n".join([*body, "12", "", "Gilowcombe Manual of Claims", "The council is paid last."]), 11, 13, {}, {})
        assert [(r[0], r[1], r[5]) for r in out if r[0] == n + 3] == [(n + 3, "title?", True)]


def test_header_that_many_documents_share(spark):
    text = "\n".join(["Gilowcombe Manual of Claims", "11", "The provider is paid.", "Gilowcombe Manual of Claims", "12", "The council is paid."])
    content = spark.createDataFrame([(i, f"c.s.d{i}", text, 11, 12, "k") for i in range(8)], CONTENT)
    got = m.found(content, spark.createDataFrame([], DOCS)).where("kind = 'header'").collect()
    assert sorted((r.section_id, r.line_no) for r in got) == [(i, n) for i in range(8) for n in (1, 4)]


def test_context_seen_once_chooses(spark):
    said = ["the modern house"] * 40 + ["old modem lines"] * 30 + ["use a modem here", "use a rnodem here", "use a RNODEM here", "the Rnodem house"]
    content = spark.createDataFrame([(i, "c.s.d", t, None, None, "k") for i, t in enumerate(said)], CONTENT)
    got = m.noise(content, spark.createDataFrame([], DOCS)).where("kind = 'char'").collect()
    assert sorted((r.section_id, r.word, r.fix) for r in got) == [(71, "rnodem", "modem"), (72, "RNODEM", "MODEM"), (73, "Rnodem", "Modern")]


def test_no_bounds_on_lines_and_words():
    noise = lambda text, first=None, last=None, fixes={}: m.section_noise(text, first, last, fixes, {})  # noqa: E731, B006
    # a broken word goes on after many lines that belong to the page
    titles = [f"Gilowcombe Manual of Claims {i}" for i in range(9)]
    for marks in ("", "12"):
        out = noise("\n".join(["The annual enroll-", *titles, marks, "ment of the provider."]), 11, 13)
        assert [(r[0], r[2]) for r in out if r[1] == "hyphen?"] == [(1, "enrollment")]
    # beside a page number a header may be long or short
    for line in ("Notes", "Manual of the " + "very " * 40 + "Long Claims"):
        out = noise("\n".join(["The provider is paid.", line, "12", "The council is paid."]), 11, 13)
        assert (2, True) in [(r[0], r[5]) for r in out if r[1] == "title?"]
    # without an end pages run on from one to the next
    text = "\n".join(x for n in range(30, 70) for x in ("The provider is paid.", str(n)))
    assert [int(r[2]) for r in noise(text, 30) if r[1] == "pageno"] == list(range(30, 70))
    assert not [r for r in noise("The provider is paid in\n1950\ndollars.", 30) if r[1] == "pageno"]
    assert len([r for r in noise("  " + " " * 40 + "31" + " " * 40, 30, 32) if r[1] == "pageno"]) == 1
    long = "electro" * 9
    assert m.explains(long, long.replace("e", "c", 5).replace("o", "0", 3)) and not m.explains("file", "the") and not m.explains("care", "0a1c")
    out = noise("Proof 0f the claim 0f the", None, None, {"0f": ["of"], "1s": ["is"]})
    assert [r[2] for r in out if r[1] == "char"] == ["0f", "0f"] and not [r for r in noise("AbC/1s+0f", None, None, {"0f": ["of"], "1s": ["is"]}) if r[1] == "char"]


def test_long_and_short_words_are_misread(spark):
    long = "electro" * 9
    said = [f"the {long} of the claim and more"] * 30 + [f"the {long.replace('e', 'c', 5)} 0f the claim"]
    content = spark.createDataFrame([(i, "c.s.d", t, None, None, "k") for i, t in enumerate(said)], CONTENT)
    got = m.noise(content, spark.createDataFrame([], DOCS)).where("kind = 'char'").collect()
    assert sorted((r.section_id, r.word, r.fix) for r in got) == sorted([(30, "0f", "of"), (30, long.replace("e", "c", 5), long)])


def test_a_full_sieve_changes_nothing(spark, monkeypatch):
    want = sorted(map(tuple, m.noise(*frames(spark)).collect()), key=str)
    monkeypatch.setattr(m, "SIEVE_BITS", 64)
    words = spark.createDataFrame([(w,) for w in BODY.lower().split()], "word string")
    assert m.sieve(words, "word").of(set(BODY.lower().split())) == set(BODY.lower().split())
    assert sorted(map(tuple, m.noise(*frames(spark)).collect()), key=str) == want


def test_one_skeleton_with_many_forms(spark, rows):
    r = __import__("random").Random(1)
    forms = {"".join(r.choice("l1ih6b") for _ in range(9)) for _ in range(400)}
    words = spark.createDataFrame([(w, 1) for w in forms] + [("hillhill", 900), ("bill", 50), ("b1ll", 2)], "word string, n bigint")
    want = {(w, t) for w in [*forms, "b1ll"] for t, n in (("hillhill", 900), ("bill", 50)) if m.explains(t, w) and m.skeleton(t) == m.skeleton(w)}
    assert want and {(r.seen, f) for r in m.misreadings(words).collect() for f in r.fixes} == want


def test_empty(spark):
    c, d = frames(spark)
    assert m.found(c.where("false"), d.where("false")).count() == m.repaired(c.where("false"), d).count() == 0
