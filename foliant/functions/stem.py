"""Porter's published stemming algorithm for English words."""

from __future__ import annotations


#: Suffixes of steps two, three and four, and what they become.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = "al ance ence er ic able ible ant ement ment ent ou ism ate iti ous ive ize".split()


def _consonant(w: str, i: int) -> bool:
    return w[i] not in "aeiou" and not (w[i] == "y" and i > 0 and _consonant(w, i - 1))


def measure(w: str) -> int:
    """Changes from vowels to consonants."""
    shape = [_consonant(w, i) for i in range(len(w))]
    return sum(a < b for a, b in zip(shape, shape[1:]))


def _vowel(w: str) -> bool:
    return any(not _consonant(w, i) for i in range(len(w)))


def _double(w: str) -> bool:
    return len(w) > 1 and w[-1] == w[-2] and _consonant(w, len(w) - 1)


def _short(w: str) -> bool:
    return len(w) > 2 and _consonant(w, len(w) - 3) and not _consonant(w, len(w) - 2) and _consonant(w, len(w) - 1) and w[-1] not in "wxy"


def _swap(w: str, table: dict[str, str]) -> str:
    for end in sorted(table, key=len, reverse=True):
        if w.endswith(end):
            base = w[: -len(end)]
            return base + table[end] if measure(base) > 0 else w
    return w


def stem_word(w: str) -> str:
    if len(w) < 3 or not w.isascii() or not w.isalpha():
        return w
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if measure(w[:-3]) > 0 else w
    else:
        for end in ("ed", "ing"):
            if w.endswith(end) and _vowel(w[: -len(end)]):
                w = w[: -len(end)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif _double(w) and w[-1] not in "lsz":
                    w = w[:-1]
                elif measure(w) == 1 and _short(w):
                    w += "e"
                break
    if w.endswith("y") and _vowel(w[:-1]):
        w = w[:-1] + "i"
    w = _swap(_swap(w, STEP_2), STEP_3)
    for end in sorted([*STEP_4, "ion"], key=len, reverse=True):
        if w.endswith(end):
            base = w[: -len(end)]
            if measure(base) > 1 and (end != "ion" or base.endswith(("s", "t"))):
                w = base
            break
    if w.endswith("e") and (measure(w[:-1]) > 1 or measure(w[:-1]) == 1 and not _short(w[:-1])):
        w = w[:-1]
    return w[:-1] if w.endswith("ll") and measure(w) > 1 else w
