"""Line weights of scraped pages, trained on labelled pages; and, for cut texts, what a line is by its form."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

from inkwell.llm import known_lines as known
from inkwell.llm.labelled_pages import PAGES

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+")
SEPARATOR = re.compile(r"\s[|·»>/]\s")
ENDS = re.compile(r"(?:[.?!…]|[.?!…\]]\s*--)[\"'”’»)\]]*$")
OPEN_ABBREVIATION = re.compile(r"(?:\b(?:Mr|Mrs|Dr|Mme|Prof|Col|Gen|Maj|No|Nr)\.|(?:\b(?:am|vom|zum|der|den)\s)\d{1,2}\.)$")
LONG = 120
#: Words that differ from page to page: numbers, months, and capitalised words that no labelled line spells the same.
_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
_ORDINALS = "first|second|third|fourth|fifth|sixth|seventh|eighth|ninth|tenth|eleventh|twelfth|thirteenth|fourteenth|fifteenth|last|upper|lower|northern|southern|eastern|western"
NAME_SLOT = r"[^\W\d_][\w'’-]+"


def lines_of(block: str) -> list[str]:
    """The lines of a block of fixed values."""
    return block.split("\n")


def labelled(pages: str = PAGES) -> tuple[list[str], list[str]]:
    """Furniture lines and record lines of labelled pages; titles of other records, which look like both, are neither."""
    marked = [row for row in pages.split("\n") if row]
    return [r[2:] for r in marked if r[0] in "-="], [r[2:] for r in marked if r[0] == "+"]


@lru_cache(maxsize=1)
def list_heads() -> frozenset[str]:
    """Headings of lists of other records, in lower case."""
    return frozenset(row[2:].lower() for row in PAGES.split("\n") if row[:1] == "=")


def features(line: str) -> list[str]:
    """Words and tags of one line; a word counts once, numbers are alike."""
    w = [x if not x.isdigit() else "0" for x in WORD.findall(line.lower())][:40]
    out = {f"w {x}" for x in w}
    out |= {f"p {a} {b}" for a, b in zip(w, w[1:])}
    if w:
        out |= {f"first {w[0]}", f"last {w[-1]}"}
    tags = {
        "separator": SEPARATOR.search(line), "arrow": "<<" in line or ">>" in line, "copyright": "©" in line, "colon": line.endswith(":"),
        "ends": ENDS.search(line), "short": len(w) <= 3, "long": len(w) >= 12, "lower": line[:1].islower(), "number": line[:1].isdigit(),
    }
    return [*out, *(f"tag {k}" for k, v in tags.items() if v)]


@lru_cache(maxsize=1)
def weights() -> dict[str, float]:
    """Weight of each word and tag: above 0 for the record, below for furniture (logistic regression, fixed steps)."""
    furniture, record = labelled()
    rows = [(features(x), y) for y, group in ((0.0, furniture), (1.0, record)) for x in group]
    index = {f: i for i, f in enumerate(sorted({f for fs, _ in rows for f in fs}))}
    x = np.zeros((len(rows), len(index)))
    for k, (fs, _) in enumerate(rows):
        x[k, [index[f] for f in fs]] = 1
    y = np.array([y for _, y in rows])
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
    w = np.zeros(len(index))
    for _ in range(600):
        p = 1 / (1 + np.exp(-(x @ w)))
        w -= 0.05 * (x.T @ (share * (p - y)) / 4 + 0.02 * w)
    return {f: float(w[i]) for f, i in index.items()}


def score(line: str) -> float:
    """Above 0: rather a line of the record; below 0: rather furniture. Blank lines score 0."""
    if not line.strip():
        return 0.0
    if len(line) > LONG:
        return 3.0 + len(line) / 100
    w = weights()
    return sum(w.get(f, 0.0) for f in features(line))


def _pattern(line: str) -> str:
    """A pattern for lines like a labelled one: numbers, dates, ordinals and names may differ."""
    plain = {x for block in (known.MENU, known.RELATED_HEADS) for x in WORD.findall(block)}
    out = []
    for k, token in enumerate(re.findall(r"[^\W_]+(?:['’][^\W_]+)*|[\W_]", line)):
        if re.fullmatch(r"(?:19|20)\d\d", token):
            out.append(r"\d{4}")
        elif token.isdigit():
            out.append(r"\d+")
        elif re.fullmatch(_MONTHS, token):
            out.append(f"(?:{_MONTHS})")
        elif re.fullmatch(_ORDINALS, token):
            out.append(f"(?:{_ORDINALS})")
        elif re.fullmatch(r"[A-R]", token) and "A to M" not in line:
            out.append("[A-Z]")
        elif k and token in NAMES and token not in plain:
            out.append(NAME_SLOT)
        else:
            out.append(re.escape(token))
    return "".join(out).replace(r"\,", ",?").replace(",", ",?").replace(",??", ",?")


#: The place names that occur in the labelled lines and stand for any.
NAMES = set(
    "Ormerhaven Marrowingate Haskermoor Skerdale Marrowvik Ruskerstow Yarastow Ormerdale Feninberry Ormaheim Braminmarket Tolinreach Tolstow "
    "Dunmere Narinmere Yarerholm Oskford Naravik Bramermoor Brammarket Zanaberry Junermoor Woldford Feninfield Caldafield Velawick Oskberry "
    "Thorncombe Lathervik Fenerberry Bramheim Ormercombe Marrowstow Ormastow Calderheim".split()
)


@lru_cache(maxsize=1)
def _patterns() -> tuple[re.Pattern, re.Pattern, re.Pattern, list[str]]:
    furniture = [*lines_of(known.FURNITURE), *lines_of(known.RELATED_HEADS)]
    both = [
        f"(?:{'|'.join(_pattern(x) for x in group)})"
        for group in (furniture, [*lines_of(known.TITLES), *lines_of(known.RECORD)], lines_of(known.TITLES))
    ]
    items = [i for row in lines_of(known.MENU) for i in row.split("|")]
    menu = "(?:" + "|".join(map(re.escape, items)) + ")"
    f = re.compile(rf"(?:{both[0]}|{menu}(?:(?:\s[|·»>/]\s|\s\s+){menu})*)", re.I)
    plain = [*furniture, *items]
    return f, re.compile(both[1], re.I), re.compile(both[2], re.I), plain


def is_furniture_form(line: str) -> bool:
    """Whether the whole line has the form of a labelled furniture line or menu."""
    return bool(_patterns()[0].fullmatch(line.strip()))


def is_record_form(line: str) -> bool:
    """Whether the whole line has the form of a labelled title, heading, list line, seal or signature."""
    return bool(_patterns()[1].fullmatch(line.strip()))


def is_title_form(line: str) -> bool:
    """Whether the whole line has the form of a record's title."""
    return bool(_patterns()[2].fullmatch(line.strip()))


def _digits(text: str) -> str:
    return re.sub(r"\d+", "0", text.lower())


@lru_cache(maxsize=1)
def _prefixes() -> tuple[set[str], set[str]]:
    def cut(group: list[str]) -> set[str]:
        out = set()
        for line in group:
            m = re.search(r"\b(?:%s)\b" % "|".join(NAMES), line)
            end = m.start() if m else len(line)
            for k in range(1, end + 1):
                out.add(_digits(line[:k]))
        return out

    return cut(_patterns()[3]), cut([*lines_of(known.TITLES), *lines_of(known.RECORD)])


def begins_furniture(line: str) -> tuple[bool, bool]:
    """Whether a line may be the beginning of a furniture line, and of a record's title, heading or list line."""
    last = re.split(r"\s[|·»>/]\s", line.rstrip())[-1]
    d, whole = _digits(last), _digits(line.rstrip())
    f, r = _prefixes()
    return bool(whole) and (whole in f or (last != line.rstrip() and d in f)), whole in r
