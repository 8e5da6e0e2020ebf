"""Noise in text from scanned pages: running lines, page numbers, divided and misread words.

Running heads and feet are lines at page edges that recur, give or take a few characters, in their
document; page numbers are lines of nothing but a number in the document's own dress, and mark the
edges.  A body line is filled to the width of the page unless it ends its paragraph, so an unfilled
line without a stop at an edge is a running line also where it stands once.  The rest of the lines
is the text: its line ends are joined, divided words by the corpus' vocabulary.

The vocabulary comes from one pass over the different texts (copies count once): the number of
texts that have a word, and of each three letters in capitalised words (names seldom recur, their
letters do).  Only entries of a documented least share are kept, which bounds both tables.

Page numbers of one dress count as such where their values rise from page to page; a misread one
among them is kept for its dress, and one beside a break for its place.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least share of documents (and number) of a vocabulary word; there are at most 1 / share times
#: the mean number of different words of a document.
WORD_SHARE, WORD_LEAST = 0.0002, 2
#: How many times more frequent the repair of a word has to be.
RATIO = 15
#: For names, shares of the texts: what a misread name and its rarest three letters stay below, and
#: what the repair's rarest three letters reach.  Below ``NAME_TEXTS`` texts they hold as for that many.
NAME_SHARE, NAME_RARE, NAME_KNOWN, NAME_TEXTS = 0.02 / RATIO, 0.004, 0.0025, 10_000
#: How many times more frequent the repair's rarest three letters have to be.
NAME_RATIO = 40
SIMILAR = 0.8

#: What is read -> what was printed.
CONFUSIONS = (
    ("c", "e"), ("l", "i"), ("l", "t"), ("0", "o"), ("f", "s"), ("cl", "d"), ("1", "l"), ("1", "i"), ("5", "s"), ("b", "h"), ("n", "u"),
    ("q", "g"), ("rn", "m"), ("vv", "w"), ("m", "in"), ("6", "b"), ("6", "é"), ("h", "li"), ("m", "rn"), ("8", "B"), ("ii", "ü"), ("I", "l"),
    ("o", "о"), ("0", "о"), ("a", "а"), ("c", "е"), ("п", "л"), ("п", "н"), ("г", "т"), ("p", "р"), ("н", "и"), ("8", "в"), ("3", "з"), ("ш", "щ"),
    ("c", "с"), ("e", "е"), ("x", "х"), ("y", "у"),
)
#: Marks that stand alone where nothing was printed.
STRAY = "~^¦°\\`•|"

_WORD = re.compile(r"[^\W_]+(?:[-'’][^\W_]+)*")
_STOP = ".!?…:;,。！？।؟．،、”»“’)\"'」"
_END = re.compile(r"[.!?…。！？।؟．][\"'”»“’)\]」]*\s*$")
_STOPPED = re.compile(r"[.!?…।؟][\"'”»“’)\]]*(?:\s|$)|[。！？．]")
_ROMAN = r"[ivxlc1]{1,8}"
_CORE = r"(?:[0-9lIOoSsBZbi|]{1,4}|[ivxlcIVXLC1]{1,8})"
_NUMBER = re.compile(rf"^(?P<a>[\[\(\-—–~*·\s]*(?:[^\W\d_]{{1,4}}\.\s*)?)(?P<n>{_CORE})(?P<z>[\]\)\-—–~*·.\s]*)$")
_HEAD_LEFT = re.compile(rf"^(?P<p>[\[\(\-—–]*\s*(?:[^\W\d_]{{1,4}}\.\s*)?{_CORE}\s*[\]\)\-—–]*)\s{{2,}}(?P<t>\S.*)$")
_HEAD_RIGHT = re.compile(rf"^(?P<t>.*\S)\s{{2,}}(?P<p>[\[\(\-—–]*\s*(?:[^\W\d_]{{1,4}}\.\s*)?{_CORE}\s*[\]\)\-—–]*)$")
_MARK = re.compile(r"^(?:[-*=_~—–.·#\s]{3,}|\[\s*[A-Z ]{3,12}\s*\]|<\s*[A-Za-z ]{3,12}/?\s*>)$")
_HYPHEN = "-‐‑­¬⸗"
_DIVIDED = re.compile(rf"([^\W\d_]+(?:[-'’][^\W\d_]+)*)[{_HYPHEN}]$")
_FIRST = re.compile(r"^[\"“„«(]*([^\W\d_]+)")
_ORDINAL = re.compile(r"^\d+(?:st|nd|rd|th|er|re|e|ème|º|ª|o|a|h|m|km|ft|in|го|й|я|е|м)?$", re.I)
_TOKEN = re.compile(r"[^\s.,;:!?…“”„«»()\"—–\[\]¿¡‚‘।؟،-]+")
_LATIN, _CYRILLIC = re.compile(r"[A-Za-zÀ-ɏ]"), re.compile(r"[Ѐ-ӿ]")


class Vocabulary:
    def __init__(self, words: dict[str, int], grams: dict[str, int], lines: list[str] | None = None, texts: int = 0) -> None:
        self.words, self.grams, self.lines, self.texts = words, grams, list(lines or []), texts
        self.most = max(self.words.values(), default=0)
        self.seen: dict[str, str | None] = {}
        self.furniture = {f for x in self.lines for f in pattern_forms(x)}

    def count(self, word: str) -> int:
        return self.words.get(word.lower(), 0)

    def least_gram(self, word: str) -> int:
        w = f"^{word.lower()}$"
        return min(self.grams.get(w[i : i + 3], 0) for i in range(len(w) - 2))


def repairs(word: str) -> Iterator[str]:
    """The word with one confusion undone."""
    for wrong, right in CONFUSIONS:
        at = word.find(wrong)
        while at >= 0:
            yield word[:at] + right + word[at + len(wrong) :]
            at = word.find(wrong, at + 1)


def misread(word: str, known: Vocabulary) -> str | None:
    """The repaired word, the word itself where it is surely wrong without a repair, or None."""
    if word in known.seen:
        return known.seen[word]
    if len(known.seen) > 100_000:
        known.seen.clear()
    found = known.seen[word] = _misread(word, known)
    return found


def _misread(word: str, known: Vocabulary) -> str | None:
    letters = sum(map(str.isalpha, word))
    digits = sum(map(str.isdigit, word))
    sure = False
    if digits:
        if letters == 0 or _ORDINAL.match(word):
            return None
        sure = letters >= 2 and bool(re.search(r"[^\W\d_]\d|\d[^\W\d_]", word)) or bool(re.fullmatch(r"[lIOSo\d]+", word))
    elif _LATIN.search(word) and _CYRILLIC.search(word):
        sure = True
    if len(word) < 3 and not sure:
        return None
    have = known.count(word)
    if not sure and have * RATIO > known.most:
        return None
    best, most = None, 0
    for fixed in repairs(word):
        n = known.count(fixed)
        if n > most:
            best, most = fixed, n
    if best and most >= max(4, RATIO * max(1, have)):
        return best
    if sure:
        return best or word
    texts = max(NAME_TEXTS, known.texts)
    if word[:1].isupper() and have < NAME_SHARE * texts and len(word) >= 4 and word.isalpha():
        low = known.least_gram(word)
        if low < NAME_RARE * texts:
            for fixed in repairs(word):
                g = known.least_gram(fixed)
                if g >= max(NAME_KNOWN * texts, NAME_RATIO * (low + texts / NAME_TEXTS)) and fixed[1:].islower() == word[1:].islower():
                    return fixed
    return None


def own_hyphen(left: str, right: str, known: Vocabulary) -> bool:
    """Whether ``left-right`` is written with its hyphen rather than divided by the line end."""
    whole, parted = known.count(left + right), known.count(f"{left}-{right}")
    if "-" in left and not whole:
        tail = left.rsplit("-", 1)[1]
        if known.count(tail + right) > parted:
            return False
    return parted > whole


def _signature(line: str) -> str:
    return re.sub(r"[\W_]+", " ", re.sub(r"\d", "0", line.casefold())).strip()


def _alike(a: str, b: str) -> bool:
    if a == b:
        return True
    if abs(len(a) - len(b)) > 0.25 * max(len(a), len(b)):
        return False
    m = SequenceMatcher(None, a, b, autojunk=False)
    return m.real_quick_ratio() >= SIMILAR and m.quick_ratio() >= SIMILAR and m.ratio() >= SIMILAR


class _Lookup:
    """Numbered signatures by their pairs of characters, so that a line meets only what could be alike.

    Strings whose ratio is ``SIMILAR`` or more have most characters in common, in few blocks; those
    with under ``LEAST`` of their pairs in common are not compared.
    """

    LEAST = 0.3

    def __init__(self) -> None:
        self.signatures: list[str] = []
        self.by_pair: dict[str, list[int]] = {}

    def add(self, signature: str) -> int:
        k = len(self.signatures)
        self.signatures.append(signature)
        for pair in _pairs(signature):
            self.by_pair.setdefault(pair, []).append(k)
        return k

    def alike(self, signature: str) -> Iterator[int]:
        pairs = _pairs(signature)
        shared: Counter[int] = Counter()
        for pair in pairs:
            shared.update(self.by_pair.get(pair, ()))
        for k in sorted(k for k, n in shared.items() if n >= self.LEAST * len(pairs)):
            if _alike(signature, self.signatures[k]):
                yield k


def _pairs(signature: str) -> set[str]:
    return {signature[i : i + 2] for i in range(len(signature) - 1)} or {signature}


#: Letters and marks read for digits, and the values of Roman letters.
DIGITS_READ = str.maketrans("lI|iOoSsZBb", "11110055286")
ROMAN_VALUES = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}


def page_value(core: str) -> int | None:
    """The number that a page number's core stands for, with digits misread as letters."""
    low = core.lower()
    if set(low) <= set(ROMAN_VALUES) and low not in ("l", "ll"):
        values = [ROMAN_VALUES[c] for c in low]
        return sum(-a if a < b else a for a, b in zip(values, [*values[1:], 0]))
    read = core.translate(DIGITS_READ)
    return int(read) if read.isascii() and read.isdigit() else None


def rising(values: list[int]) -> list[int]:
    """Places of a longest strictly rising sequence."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k] = v
            at[k] = i
        before[i] = at[k - 1] if k else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def pattern_of(line: str) -> str:
    """Words with capitals as X, digits as 0, the others as they are."""
    return " ".join("X" if w[:1].isupper() else re.sub(r"\d+", "0", w) for w in line.split())


def pattern_forms(line: str) -> list[str]:
    """The line's pattern and, from four words on, its forms with one small word left open."""
    words = pattern_of(line).split()
    if len(words) < 4:
        return [" ".join(words)]
    return [" ".join(words)] + [" ".join("*" if j == k else w for j, w in enumerate(words)) for k in range(len(words)) if words[k] != "X"]


class Pages:
    """One document's lines by role: ``roles[i]`` is text, blank, mark, page_number, header or footer."""

    def __init__(self, text: str, furniture: frozenset[str] | set[str] = frozenset()) -> None:
        self.text = text
        self.raw = text.split("\n")
        self.lines = [x.replace("\f", "").strip() for x in self.raw]
        self.roles = ["text" if x else "blank" for x in self.lines]
        self.paged = False
        self.furniture = furniture
        self._find()

    # -- steps ---------------------------------------------------------------------------------
    def _find(self) -> None:
        lines, roles = self.lines, self.roles
        solid = [i for i, x in enumerate(lines) if x]
        if len(solid) < 3:
            return
        words = sum(x.count(" ") + 1 for x in lines if x)
        if len(_STOPPED.findall(self.text)) * 60 < words:
            return
        feeds = {i for i, x in enumerate(self.raw) if "\f" in x}
        marks = [i for i in solid if _MARK.match(lines[i])]
        for i in marks:
            roles[i] = "mark"
        body = [i for i in solid if roles[i] == "text"]
        if not body:
            return
        goes_on = [len(lines[i]) for i, j in zip(body, body[1:]) if lines[j][:1].islower()]
        lengths = sorted(goes_on if len(goes_on) >= 5 else [len(lines[i]) for i in body])
        width = lengths[min(len(lengths) - 1, int(0.98 * len(lengths)))]
        if width > 140 or width < 16:
            return
        self.width = width
        numbers = self._numbers(body, set(marks), feeds)
        for i in numbers:
            roles[i] = "page_number"
        headed = self._headed([i for i in body if i not in numbers])
        for i in headed:
            roles[i] = "header"
        breaks = set(marks) | feeds
        edges = self._edges(breaks, numbers, headed)
        clusters = self._clusters(edges)
        paged = len(numbers) >= 2 or len(headed) >= 2 or any(len(c) >= 2 for c in clusters) or bool(numbers) and self._at_end(numbers)
        paged = paged or bool(breaks) and bool(numbers or headed or clusters)
        if not paged:
            self.roles[:] = ["text" if r not in ("blank", "mark") else r for r in roles]
            return
        self.paged = True
        accepted: list[list[int]] = []
        for c in clusters:
            if len(c) >= 2 or self._once(c[0], breaks, numbers):
                accepted.append(c)
                for i in c:
                    roles[i] = "running"
        self._sides(accepted, breaks, numbers)

    def _numbers(self, body: list[int], marks: set[int], feeds: set[int]) -> set[int]:
        found: dict[int, str] = {}
        values: dict[int, int | None] = {}
        for i in body:
            m = _NUMBER.match(self.lines[i])
            if m and (any(c.isdigit() for c in m["n"]) or re.fullmatch(r"[ivxlcIVXLC1lO]+", m["n"])):
                n = m["n"]
                if n.isalpha() and not (n.islower() and set(n) <= set("ivxlc") or n in ("lOO", "lO", "lOl", "IO")):
                    continue
                a, z = m["a"].strip(), m["z"].strip()
                if any(z.count(y) != a.count(x) for x, y in ("[]", "()")) or z[-1:] == ".":
                    continue
                found[i] = f"{a}#{z}"
                values[i] = page_value(n)
        if not found:
            return set()
        styles = Counter(found.values())
        first, last = body[0], body[-1]
        ends = {first, last} | {i for i in body if i - 1 in marks or i + 1 in marks or i in feeds}
        near = set()
        solid = [i for i, x in enumerate(self.lines) if x]
        if len(solid) > 1:
            near = {solid[0], solid[1], solid[-1], solid[-2]}
        style, n = styles.most_common(1)[0]
        if len(found) == 1:
            i = next(iter(found))
            if i == last and not marks and not feeds and i > 0 and self.lines[i - 1] and not _END.search(self.lines[i - 1]) and self.lines[i - 1][:1].islower():
                return set()
        dressed = [i for i, s in found.items() if s == style]
        told = [i for i in dressed if values[i] is not None]
        in_order = rising([values[i] for i in told])
        # a sequence of pages, misread members included; equal or falling numbers are none
        sequence = set(dressed) if n >= 2 and len(in_order) >= 2 and 2 * len(in_order) >= len(dressed) else set()
        return {i for i in found if i in sequence or i in ends or i in near and len(found) == 1}

    def _headed(self, body: list[int]) -> set[int]:
        """Lines of a title and a page number, apart by blanks."""
        found = {}
        for i in body:
            for pattern in (_HEAD_RIGHT, _HEAD_LEFT):
                m = pattern.match(self.lines[i])
                if m and len(m["t"]) >= 4 and not _END.search(m["t"]) and any(c.isdigit() or c in "ivxlcl" for c in m["p"]):
                    if sum(1 for w in m["t"].split() if w[:1].isupper() or w[:1].isdigit()) * 2 >= len(m["t"].split()) or m["t"].isupper():
                        found[i] = m["t"]
                    elif m["t"][:1].isupper() and len(self.lines[i]) < self.width + 12:
                        found[i] = m["t"]
                    break
        return set(found)

    def _unfilled(self, i: int) -> bool:
        """No stop at its end, and the next line's first word would have had room."""
        x = self.lines[i]
        if not x or _END.search(x) or x[-1] in _HYPHEN + ",;":
            return False
        nxt = next((self.lines[j] for j in range(i + 1, len(self.lines)) if self.roles[j] in ("text", "header") and j != i), "")
        word = nxt.split()[0] if nxt.split() else ""
        return len(x) + 1 + len(word) <= self.width

    def _edges(self, breaks: set[int], numbers: set[int], headed: set[int]) -> list[int]:
        """Lines beside a break, a page number, a numbered head, or the text's start or end."""
        n = len(self.lines)
        seen: list[int] = []

        def walk(i: int, step: int, most: int) -> None:
            taken = 0
            while 0 <= i < n and taken < most:
                role = self.roles[i]
                if role == "text":
                    seen.append(i)
                    taken += 1
                elif role not in ("blank", "page_number", "header") :
                    break
                i += step

        for i in breaks:
            feed = self.roles[i] == "text" or self.roles[i] == "page_number" or self.roles[i] == "header"
            walk(i if feed else i + 1, 1, 1)
            walk(i - 1, -1, 1)
        for i in numbers | headed:
            walk(i + 1, 1, 1)
            walk(i - 1, -1, 1)
        walk(0, 1, 1)
        walk(n - 1, -1, 1)
        # the second line at an edge, where the first one is a running line
        return sorted(set(seen))

    def _clusters(self, edges: list[int]) -> list[list[int]]:
        usable = [i for i in edges if 6 <= len(self.lines[i]) <= self.width + 14 and not _END.search(self.lines[i]) and self.lines[i][-1] not in _HYPHEN + ",;"]
        usable = [i for i in usable if self.lines[i][:1].isupper() or self.lines[i][:1].isdigit() or not self.lines[i][:1].isalpha() or not self.lines[i][:1].islower()]
        known, members = _Lookup(), []
        for i in usable:
            sig = _signature(self.lines[i])
            if not sig:
                continue
            k = next(known.alike(sig), None)
            if k is None:
                known.add(sig)
                members.append([i])
            else:
                members[k].append(i)
        out = members
        strong = [m for m in out if len(m) >= 2]
        if strong:
            # lines elsewhere that are like an accepted cluster's
            elsewhere, where = _Lookup(), {}
            sizes = {len(self.lines[m[0]]) + k for m in strong for k in range(-6, 7)}
            for i, x in enumerate(self.lines):
                if self.roles[i] == "text" and 6 <= len(x) <= self.width + 14 and len(x) in sizes:
                    where.setdefault(_signature(x), []).append(i)
            for sig in where:
                elsewhere.add(sig)
            for k, m in enumerate(members):
                if len(m) >= 2:
                    own, size = set(m), len(self.lines[m[0]])
                    near = sorted(i for j in elsewhere.alike(known.signatures[k]) for i in where[elsewhere.signatures[j]])
                    m.extend(i for i in near if i not in own and abs(len(self.lines[i]) - size) <= 6)
        taken = {i for m in strong for i in m}
        return strong + [m for m in out if len(m) == 1 and m[0] not in taken]

    def _at_end(self, numbers: set[int]) -> bool:
        solid = [i for i, x in enumerate(self.lines) if x]
        return bool(numbers & {*solid[:2], *solid[-2:]}) and len(solid) >= 4 and self._wrapped()

    def _wrapped(self) -> bool:
        body = [x for x, r in zip(self.lines, self.roles) if r == "text"]
        if len(body) < 3:
            return False
        return sum(1 for x in body if not _END.search(x)) >= 0.4 * len(body)

    def _once(self, i: int, breaks: set[int], numbers: set[int]) -> bool:
        """A running line that stands once: unfilled, without a stop, in the words of a title."""
        if not self._unfilled(i):
            return False
        words = self.lines[i].split()
        if len(words) < 2 and not self.lines[i].isupper():
            return False
        if any(f in self.furniture for f in pattern_forms(self.lines[i])):
            return True
        if self._noun_capitals():
            return False
        long = [w for w in words if len(w) > 3 and w[0].isalpha()]
        return len(long) >= 2 and self.lines[i][:1].isupper() and sum(1 for w in long if w[0].isupper()) >= 0.75 * len(long)

    def _noun_capitals(self) -> bool:
        """Whether long words have capitals so often that they tell no title (German)."""
        long = [w for x, r in zip(self.lines, self.roles) if r == "text" for w in x.split()[1:] if len(w) > 3 and w[0].isalpha()]
        return sum(1 for w in long if w[0].isupper()) > 0.33 * len(long)

    def _sides(self, clusters: list[list[int]], breaks: set[int], numbers: set[int]) -> None:
        roles, lines = self.roles, self.lines
        n = len(lines)
        texts = [i for i, r in enumerate(roles) if r == "text"]
        if not texts:
            lo, hi = 0, n
        else:
            lo, hi = texts[0], texts[-1]
        cut = sorted(i for i in breaks)
        for c in clusters:
            votes = 0
            for i in c:
                if i < lo:
                    votes += 3
                elif i > hi:
                    votes -= 3
                elif cut:
                    below = next((t for t in texts if t > i), n)
                    above = next((t for t in reversed(texts) if t < i), -1)
                    after = any(above < b <= i for b in cut)
                    before = any(i < b <= below for b in cut)
                    votes += (1 if after else 0) - (1 if before else 0)
            side = "header" if votes > 0 else "footer" if votes < 0 else None
            if side is None:
                side = self._by_numbers(c, numbers, texts)
            for i in c:
                own = side
                if cut and lo <= i <= hi:
                    below = next((t for t in texts if t > i), n)
                    above = next((t for t in reversed(texts) if t < i), -1)
                    after = any(above < b <= i for b in cut)
                    before = any(i < b <= below for b in cut)
                    if after != before:
                        own = "header" if after else "footer"
                roles[i] = own

    def _by_numbers(self, cluster: list[int], numbers: set[int], texts: list[int]) -> str:
        """Without a break: where page numbers end pages, lines above one are feet, below it heads."""
        lead = sum(1 for i in numbers if not texts or i < texts[0])
        trail = sum(1 for i in numbers if not texts or i > texts[-1])
        score = 0
        for i in cluster:
            up = any(self.roles[j] == "page_number" for j in range(max(0, i - 2), i))
            down = any(self.roles[j] == "page_number" for j in range(i + 1, min(len(self.lines), i + 3)))
            score += (1 if up else 0) - (1 if down else 0)
        if lead and not trail:
            return "header"
        return "header" if score >= 0 else "footer"


def examine(text: str, known: Vocabulary) -> tuple[list[tuple[int, str]], str] | None:
    """The noisy lines ``(line_no, kind)`` of a document set in pages, and its repaired text.

    None where the document is not set in pages.
    """
    pages = Pages(text, known.furniture)
    if not pages.paged:
        return None
    found: list[tuple[int, str]] = []
    for i, role in enumerate(pages.roles):
        if role in ("header", "footer", "page_number"):
            found.append((i + 1, role))
    body = [i for i, role in enumerate(pages.roles) if role == "text"]
    fixed: dict[int, str] = {}
    joins: dict[int, bool] = {}  # line -> whether its last word goes on (True: without its hyphen)
    for at, i in enumerate(body):
        line = pages.lines[i]
        divided = _DIVIDED.search(line)
        nxt = body[at + 1] if at + 1 < len(body) else None
        head = _FIRST.match(pages.lines[nxt]) if nxt is not None else None
        if divided and head:
            left, right = divided[1].split("’")[-1], head[1]
            hard = line[-1] in "-‐‑"
            own = hard and own_hyphen(left, right, known)
            if not own and (right[:1].islower() or not hard or right.lower() == right.upper()):
                found.append((i + 1, "hyphen"))
                joins[i] = True
            elif hard:
                joins[i] = False
        before = body[at - 1] if at else None
        wrong = _misread_tokens(line, known, skip_first=joins.get(before) is True, skip_last=joins.get(i) is True)
        if wrong:
            found.append((i + 1, "misread"))
        for a, b in wrong:
            line = re.sub(rf"(?<!\w){re.escape(a)}(?!\w)", b.replace("\\", r"\\"), line, count=1) if b else re.sub(rf"\s*(?<!\S){re.escape(a)}(?!\S)", "", line, count=1)
        fixed[i] = line
    return sorted(found), _joined(pages, body, fixed, joins)


def _misread_tokens(line: str, known: Vocabulary, skip_first: bool, skip_last: bool) -> list[tuple[str, str]]:
    out = []
    for m in re.finditer(rf"(?<!\S)[{re.escape(STRAY)}](?!\S)", line):
        out.append((m[0], ""))
    tokens = list(_TOKEN.finditer(line))
    for k, m in enumerate(tokens):
        word = m[0].strip("'’‘")
        if len(word) < 2 or (k == 0 and skip_first) or (k == len(tokens) - 1 and skip_last):
            if not (any(map(str.isdigit, word)) and any(map(str.isalpha, word))) or len(word) < 3:
                continue
        if word.endswith(("'s", "’s")):
            word = word[:-2]
        better = misread(word, known)
        if better is not None:
            out.append((word, better))
    return out


def _joined(pages: Pages, body: list[int], fixed: dict[int, str], joins: dict[int, bool]) -> str:
    """Paragraphs on one line each: an empty line, or an indented first line, starts one."""
    parts: list[str] = []
    for at, i in enumerate(body):
        line = fixed[i]
        if not parts:
            parts.append(line)
            continue
        prev = body[at - 1]
        gap = any(pages.roles[j] == "blank" for j in range(prev + 1, i)) and all(pages.roles[j] in ("blank",) for j in range(prev + 1, i))
        indented = pages.raw[i].replace("\f", "")[:1] in " \t　"
        ended = bool(_END.search(fixed[prev]))
        if prev in joins:
            parts[-1] = parts[-1][:-1] + line if joins[prev] else parts[-1] + line
        elif (gap or indented) and (ended or gap and not line[:1].islower()):
            parts.append(line)
        elif parts[-1] and line and _wide(parts[-1][-1]) and _wide(line[0]):
            parts[-1] += line
        else:
            parts[-1] += " " + line
    return "\n\n".join(parts)


def _wide(c: str) -> bool:
    return "぀" <= c <= "鿿" or "豈" <= c <= "﫿" or "　" <= c <= "〿" or "฀" <= c <= "๿"


# -- corpus ------------------------------------------------------------------------------------

COUNTS = "kind string, key string, docs long"


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter[str] = Counter()
    grams: Counter[str] = Counter()
    recurring: Counter[str] = Counter()
    docs = 0

    def flush() -> pa.RecordBatch:
        keys = [*words, *grams, *recurring]
        kinds = ["w"] * len(words) + ["g"] * len(grams) + ["l"] * len(recurring)
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds), pa.array(keys, pa.string()), pa.array([*words.values(), *grams.values(), *recurring.values()], pa.int64())],
            ["kind", "key", "docs"],
        )

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text is None:
                continue
            docs += 1
            found = set(_WORD.findall(text))
            words.update({w.lower() for w in found if len(w) <= 32})
            names = {w.lower() for w in found if 3 <= len(w) <= 32 and w[0].isupper() and w.isalpha()}
            grams.update(g for w in names for g in _grams(w))
            lines = Counter(x.strip() for x in text.split("\n"))
            recurring.update({pattern_of(x) for x, n in lines.items() if n > 1 and 10 <= len(x) <= 80 and not _END.search(x) and x[0].isupper()})
            if len(words) > 400_000:
                yield flush()
                words, grams, recurring = Counter(), Counter(), Counter()
    words[""] = docs
    yield flush()


def _grams(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + 3] for i in range(len(w) - 2)]


def distinct_texts(documents: DataFrame) -> DataFrame:
    """``(text)``: one, the least, of the texts that are the same in N(text)."""
    bare = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", "")
    content = F.xxhash64(F.when(bare == "", F.col("text")).otherwise(bare))
    return documents.where("text is not null").groupBy(content.alias("content")).agg(F.min("text").alias("text")).select("text")


def vocabulary(documents: DataFrame, share: float = WORD_SHARE) -> Vocabulary:
    """Words, name trigrams and patterns of recurring lines by the number of different texts that have them."""
    from ..session import materialize

    counts = distinct_texts(documents).mapInArrow(_counts, COUNTS).groupBy("kind", "key").agg(F.sum("docs").alias("docs"))
    counts = materialize(counts, "vocabulary")
    total = counts.where("kind = 'w' and key = ''").agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    kept = counts.where((F.col("docs") >= WORD_LEAST) & (F.col("docs") >= F.lit(share * total))).toPandas()
    words = kept[(kept.kind == "w") & (kept.key != "")]
    grams = kept[kept.kind == "g"]
    lines = kept[kept.kind == "l"]
    return Vocabulary(dict(zip(words.key, words.docs.astype(int))), dict(zip(grams.key, grams.docs.astype(int))), sorted(lines.key), total)


def _examiner(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(*shared.value)
        for batch in batches:
            ids, paged, texts, lines = [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is None or key is None:
                    continue
                got = examine(text, known)
                ids.append(key)
                paged.append(got is not None)
                texts.append(text if got is None else got[1])
                lines.append([] if got is None else [{"line_no": n, "kind": k} for n, k in got[0]])
            kind = pa.list_(pa.struct([("line_no", pa.int32()), ("kind", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(paged, pa.bool_()), pa.array(texts, pa.string()), pa.array(lines, kind)],
                ["doc_id", "paged", "repaired", "noise"],
            )

    return run


EXAMINED = "doc_id long, paged boolean, repaired string, noise array<struct<line_no:int,kind:string>>"


def examined(documents: DataFrame, known: Vocabulary | None = None) -> DataFrame:
    """Every document with a text: whether it is set in pages, its repaired text, its noisy lines.

    Documents not set in pages come back as they are.
    """
    known = known or vocabulary(documents)
    shared = documents.sparkSession.sparkContext.broadcast((known.words, known.grams, known.lines, known.texts))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_examiner(shared), EXAMINED)


def noisy_lines(documents: DataFrame, known: Vocabulary | None = None) -> DataFrame:
    """``(doc_id, line_no, kind)``: running lines, page numbers, divided and misread words.

    Null and blank texts have none; a repeated row counts once; an empty table gives no rows.
    """
    found = examined(documents, known).where("paged").select("doc_id", F.explode("noise").alias("x"))
    return found.select("doc_id", F.col("x.line_no").alias("line_no"), F.col("x.kind").alias("kind")).distinct()
