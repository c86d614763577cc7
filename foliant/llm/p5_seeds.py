"""Labelled documents for the induction of the text quality rules.

They are made here from a seed: prose (plain, wrapped into lines, with a short list, upper case, one line), lists (bullets, numbers, plain
entries, tables of contents), tables (bars, tabs, quoted cells, aligned columns) and junk (random letters, single
characters, broken encodings, blank forms, encoded binary data). ``PER_KIND`` bounds the sample.
"""

from __future__ import annotations

import base64
import random

PER_KIND = 160
_NOUN = "claim provider account report payment section office record policy contract member notice review audit service plan budget order permit survey grant form letter invoice ledger agency clinic panel".split()
_ADJ = "annual monthly final local prior covered public urgent partial regional secondary approved standard general internal federal joint pending complete minor".split()
_VERB = "reviewed approved submitted recorded denied adjusted closed measured reported released updated certified".split()
_SMALL = "the a of to and in for is that must may with by on or be not each any this when before after under unless within".split()


def _phrase(r: random.Random) -> str:
    return r.choice([lambda: f"{r.choice(_ADJ)} {r.choice(_NOUN)}", lambda: f"{r.choice(_NOUN)} of the {r.choice(_ADJ)} {r.choice(_NOUN)}", lambda: f"{r.choice(_VERB)} {r.choice(_NOUN)} for {r.choice(_ADJ)} {r.choice(_NOUN)}", lambda: f"{r.choice(_ADJ)} {r.choice(_NOUN)} {r.choice(_NOUN)}"])()


def _sentence(r: random.Random) -> str:
    n = r.choice(_NOUN)
    s = r.choice([
        lambda: f"The {r.choice(_ADJ)} {n} must be {r.choice(_VERB)} before the {r.choice(_NOUN)} of each {r.choice(_NOUN)} is {r.choice(_VERB)}",
        lambda: f"If the {n} was {r.choice(_VERB)} on {r.randint(1, 12):02}/{r.randint(1, 28):02}/{r.randint(1990, 2024)}, the {r.choice(_NOUN)} should be {r.choice(_VERB)} by the {r.choice(_ADJ)} {r.choice(_NOUN)}",
        lambda: f"Payment of ${r.randint(1, 90000):,}.{r.randint(10, 99)} is made to the {r.choice(_ADJ)} {n} after the {r.choice(_NOUN)} is {r.choice(_VERB)}",
        lambda: f"Under section {r.randint(1, 90)}.{r.randint(1, 90)}, each {n} and any {r.choice(_ADJ)} {r.choice(_NOUN)} are {r.choice(_VERB)} within 30 days",
        lambda: f"Codes {r.choice('AEGJ')}{r.randint(1000, 9999)} and {r.choice('QTV')}{r.randint(1000, 9999)} apply to the {n} that has not been {r.choice(_VERB)}",
    ])()
    while r.random() < 0.35:
        s += r.choice([", unless the ", " and the ", "; in that case the ", ", where the "]) + f"{r.choice(_ADJ)} {r.choice(_NOUN)} of the {r.choice(_NOUN)} has been {r.choice(_VERB)} by another {r.choice(_NOUN)}"
    return s + r.choice(["."] * 9 + ["?"])


def _wrap(text: str, width: int) -> list[str]:
    import textwrap

    return textwrap.wrap(text, width)


def _prose(r: random.Random) -> str:
    style = r.choice([0, 1, 1, 2, 2, 3, 4, 5, 6, 7, 8])
    paras = [" ".join(_sentence(r) for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 6))]
    if style == 0:
        return r.choice(["\n", "\n\n"]).join(paras)
    if style in (1, 2):
        lines = [x for p in paras for x in [*_wrap(p, r.randint(40, 82)), *([""] if r.random() < 0.3 else [])]]
        for _ in range(r.randint(0, 6)):
            lines.insert(r.randrange(len(lines) + 1), r.choice([str(r.randint(1, 2000)), f"Page {r.randint(1, 300)}", f"{r.randint(1, 99)},{r.randint(100, 999)}", f"Chapter {r.randint(1, 40)} - {_phrase(r).title()}"]))
        return "\n".join(lines)
    if style == 3:
        entries = [r.choice(["- ", "* ", "(a) "]) + _phrase(r) for _ in range(r.randint(2, 4))]
        paras = paras + [_sentence(r) for _ in range(5)]
        return "\n".join([*paras[:2], *entries, *paras[2:]])
    if style == 4:
        return "\n".join(paras).upper()
    if style == 5:
        return r.choice([lambda: "Not used.", lambda: "Reserved", lambda: f"See section {r.randint(1, 90)}.{r.randint(1, 90)}.", lambda: _phrase(r), lambda: _sentence(r), lambda: _sentence(r) + " " + _sentence(r), lambda: _sentence(r) + "\n" + _sentence(r), lambda: _phrase(r).capitalize() + "."])()
    if style == 6:
        gaps = [" "] * 5 + ["  ", "\t", "\xa0", " ", "　"]
        return "\n".join("".join(w + r.choice(gaps) for w in p.split()) for p in paras)
    if style == 8:  # sentences that run on, without stops
        runs = [" and ".join(x.rstrip(".?").lower() for x in (_sentence(r) for _ in range(r.randint(1, 6)))) for _ in range(r.randint(1, 7))]
        return "\n".join(x + r.choice(["", ".", ","]) for x in runs)
    head = [r.choice([f"Prepared by the {_phrase(r)} desk", f"(Rev. {r.randint(1, 999)}; issued: 0{r.randint(1, 9)}-12-0{r.randint(1, 9)})", f"{_NOUN[0]} guide > {_phrase(r)}", f"Transmittal {r.randint(1, 999)}, issued 0{r.randint(1, 9)}-02-11, effective upon review of the {_phrase(r)}"]) for _ in range(r.randint(1, 4))]
    return "\n".join([*head, *paras])


def _list(r: random.Random) -> str:
    style, n = r.randrange(6), r.randint(4, 30)
    phrase = lambda: r.choice([str.capitalize, str])(_phrase(r)) + r.choice([""] * 5 + [",", ";", "; and"])
    if style == 0:
        mark = r.choice("-•*–")
        lines = [f"{mark} {phrase()}" for _ in range(n)]
    elif style == 1:
        form = r.choice(["{}. ", "{}) ", "({}) "])
        lines = [form.format(i + 1) + phrase() for i in range(n)]
    elif style == 2:
        form = r.choice(["{}. ", "{}) ", "({}) "])
        lines = [form.format("abcdefghijklmnopqrstuvwxyz"[i % 26]) + phrase() for i in range(n)]
    elif style == 3:
        lines = [phrase() for _ in range(n)]
    elif style == 4:
        at, lines = 0, []
        for _ in range(n):
            at += r.randint(1, 5)
            lines.append(f"{_phrase(r).capitalize()} {'.' * r.randint(6, 42)} {at}")
    else:
        at, lines = 0, []
        for i in range(n):
            at += r.randint(1, 5)
            lines.append(f"{r.randint(1, 90)}.{i + 1} {_phrase(r).capitalize()}{r.choice(['    ', chr(9), ' '])}{at}")
    if r.random() < 0.4:
        lines.insert(0, _phrase(r).capitalize() + ":")
    return "\n".join(lines)


def _cell(r: random.Random, kind: int) -> str:
    if r.random() < 0.12:
        return ""
    return [lambda: r.choice(_NOUN), lambda: r.choice(_ADJ), lambda: f"{r.choice('AEGJQTV')}{r.randint(1000, 9999)}", lambda: f"${r.randint(1, 90000):,}.{r.randint(10, 99)}", lambda: f"{r.randint(1, 90)}.{r.randint(1, 90)}.{r.randint(1, 90)}", lambda: f"{r.randint(1990, 2024)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}", lambda: f"March {r.randint(1, 28)}, {r.randint(1990, 2024)}"][kind]()


def _table(r: random.Random) -> str:
    cols, n, style = r.randint(3, 6), r.randint(3, 30), r.randrange(5)
    kinds = [r.randrange(7) for _ in range(cols)]
    rows = [[_phrase(r).title() for _ in range(cols)], *([_cell(r, k) for k in kinds] for _ in range(n))]
    if style in (0, 1):
        lines = ["| " + " | ".join(x) + " |" for x in rows]
        lines.insert(1, "| " + " | ".join(["---"] * cols) + " |")
    elif style == 2:
        lines = ["\t".join(x) for x in rows]
    elif style == 3:
        sep = r.choice([";", ","])
        lines = [sep.join(f'"{c}"' for c in x) for x in rows]
    else:
        width = r.randint(20, 36)
        lines = ["".join(c[: width - 2].ljust(width) for c in x).rstrip() for x in rows]
    if r.random() < 0.35:
        lines.insert(0, f"Table {r.randint(1, 50)} - {_phrase(r)}")
    return "\n".join(lines)


def _junk(r: random.Random) -> str:
    style, n = r.randrange(6), r.randint(8, 120)
    if style == 0:
        return " ".join("".join(r.choice("bcdfghjklmnpqrstvwxz") for _ in range(r.randint(2, 10))) for _ in range(n))
    if style == 1:
        return " ".join(r.choice("ilrtnsaoue1I!|.,-`'") for _ in range(n * 2))
    if style == 2:
        return " ".join("".join(r.choice(["Ã©", "â€™", "Å¡", "Ã¼", "Â§", "�", "ï»¿", "s", "a", "e", "t", "r", "l", "n", "d", "o", "i"]) for _ in range(r.randint(2, 7))) for _ in range(n))
    if style == 3:
        return "\n".join(" ".join(r.choice(["____", "--", "::", "=====", "[ ]", "|", ".....", "__/__/__"]) for _ in range(r.randint(2, 9))) for _ in range(r.randint(1, 12)))
    if style == 4:
        raw = base64.b64encode(r.randbytes(48 * r.randint(2, 30))).decode()
        return "\n".join(raw[i : i + 64] for i in range(0, len(raw), 64))
    return "".join(r.choice("0123456789&@#%*_^\\/{}[]<>:;=?!+ ") for _ in range(n * 4))


def seeds(per_kind: int = PER_KIND, seed: int = 11) -> list[tuple[str, str]]:
    """``(kind, text)``; prose, which has the most forms, three times as often."""
    r = random.Random(seed)
    make = {"prose": _prose, "list": _list, "table": _table, "junk": _junk}
    return [(kind, f(r)) for kind, f in make.items() for _ in range(per_kind * (3 if kind == "prose" else 1))]
