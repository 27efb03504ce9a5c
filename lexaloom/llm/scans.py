"""Repair of text from scanned pages.

Words of texts that aren't scanned make a dictionary, counted over all rows.
Lines of a scanned text are told apart (running headers, page numbers, text);
what is left is one stream of characters without lines. Where words of the
dictionary follow one another they stand; the stretches between are decoded
jointly, by the cheapest path over words as they stand, as they were meant
before confusions, across blanks that shouldn't be there and those that are
missing, and over hyphens at line ends. Paragraph boundaries are a cheapest
path over the lines.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexaloom.session import cut

# What is read for what (left: seen on the page image, right: meant).
CONFUSIONS = [
    ("1", "l"), ("|", "l"), ("0", "o"), ("5", "s"), ("c", "e"), ("j", "i"), ("f", "t"), ("b", "h"), ("q", "g"), ("rn", "m"), ("ri", "n"),
    ("vv", "w"), ("ii", "u"), ("ii", "ü"), ("cl", "d"), ("h", "li"), ("d", "cl"), ("1", "i"), ("|", "i"), ("l", "i"), ("i", "l"), ("m", "rn"),
    ("8", "b"), ("9", "g"), ("6", "b"), ("2", "z"), ("o", "ö"), ("u", "ü"), ("a", "ä"), ("0", "ö"), ("e", "é"), ("c", "é"), ("e", "è"), ("c", "è"), ("j", "í"),
    ("n", "ñ"), ("a", "á"), ("i", "í"), ("o", "ó"), ("u", "ú"), ("a", "à"), ("a", "â"), ("e", "ê"), ("i", "î"), ("o", "ô"), ("u", "ù"), ("u", "û"), ("c", "ç"),
]
# Those that also count in names, which no dictionary holds.
IN_NAMES = 15
HYPHENS = "-\u2010\u2011\u00ac\u00ad"
SURE_HYPHENS = "\u00ac\u00ad"
ORNAMENT = " \t\f—–-_=~*·•.|[](){}<>«»:"
ROMAN = re.compile(r"(?=[ivxlcdm])m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})", re.I)
NUMBER = re.compile(r"(?P<lead>[^\w\s]{0,3})\s*(?P<word>page|seite|página|pagina|pág\.?|p\.|s\.)?\s*(?P<n>[0-9lIO|o]{1,5}|[ivxlcdmIVXLCDM]{1,10})(?P<of>\s*(?:/|of|von|de|sur)\s*[0-9lIO|o]{1,5})?\s*(?P<tail>[^\w\s]{0,3})", re.I)
NUMBERED = [re.compile(r"\s*(?P<t>\S.*?)(?P<gap>\s*[|·•/]\s*|\s{2,})(?P<n>[0-9lIO|o]{1,5}|[ivxlcdm]{1,10})\s*$"), re.compile(r"\s*(?P<n>[0-9lIO|o]{1,5}|[ivxlcdm]{1,10})(?P<gap>\s*[|·•/]\s*|\s{2,})(?P<t>\S.*?)\s*$")]
ENDS = re.compile(r"[.!?…:;,]['\"”’»)\]]*(?:\[\d+\])*$|[\"”’»\]]$")
RUN = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
AROUND = ".,;:!?\"()«»„“”–—[]*…¿¡'’`"
FENCED = re.compile(r"\s*```|#{1,6} ")
TABLE = re.compile(r"\s*\|(?:[^|]*\|){2,}\s*")
LETTERS = re.compile(r"[^\W\d_]")
#: A word must make up this share of all words to enter the dictionary, which bounds it to twenty million; in natural text far fewer do.
LEAST_SHARE = 5e-8
#: Costs of a path: a confusion, a blank too many or missing, a token no word explains, a hyphen kept between words.
CONFUSED, BLANK, UNKNOWN, KEPT = 4.0, 8.0, 30.0, 40.0
#: Tokens a path may take as one stretch of characters, and words it may find in it.
STRETCH, WORDS_IN = 3, 4
WIDEST = 90


def fold(text: str) -> str:
    """A key that lines with reading errors have in common."""
    t = "".join(c for c in unicodedata.normalize("NFKD", text).casefold() if not unicodedata.combining(c))
    t = t.translate({ord("1"): "l", ord("|"): "l", ord("0"): "o", ord("5"): "s", ord("i"): "l", ord("j"): "l", ord("c"): "e", ord("f"): "t", ord("b"): "h", ord("q"): "g"})
    t = re.sub(r"[\W_]+", "", t)
    for seen, meant in (("rn", "m"), ("rl", "n"), ("vv", "w"), ("ll", "u"), ("el", "d"), ("ü", "u")):
        t = t.replace(seen, meant)
    return t


def value(text: str) -> int | None:
    """The number a page number stands for."""
    t = text.lower().replace("|", "l")
    if ROMAN.fullmatch(t):
        n, last = 0, 0
        for c in reversed(t):
            v = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}[c]
            n, last = (n - v, last) if v < last else (n + v, v)
        return n
    t = t.translate({ord("l"): "1", ord("i"): "1", ord("o"): "0"})
    return int(t) if t.isdigit() else None


def wrapped(lines: list[str]) -> bool:
    """True if a text stands in lines of a page's width."""
    full = [len(x) for x in lines if x.strip()]
    return len(full) >= 4 and max(full) <= WIDEST and sum(n > 0.6 * max(full) for n in full) >= 0.5 * len(full)


@dataclass
class Piece:
    """A decoded piece of the stream: its words, the line it begins in, and kinds of lines it gives."""

    words: list[str]
    lines: list[int]
    marks: list[tuple[int, str]]


def _bases() -> dict[str, str]:
    """What each letter is made of, so that texts which confusions turn into one another are made of the same: a key for all of them."""
    base = {"n": "rl", "m": "rrl", "w": "vv", "u": "ll", "d": "el", "h": "ll", "b": "ll", "l": "l", "i": "l", "e": "e", "c": "e"}
    while True:  # single letters follow what they are confused with
        new = dict(base)
        for seen, meant in CONFUSIONS:
            if len(seen) == len(meant) == 1:
                a, b = new.get(seen), new.get(meant)
                if a is None or b is None:
                    both = a or b or meant
                    new[seen] = new[meant] = both
        if new == base:
            return base
        base = new


BASES = str.maketrans(_bases())


def skeleton(word: str) -> str:
    return word.translate(BASES)


class Reader:
    """Tells lines apart and decodes words with a dictionary."""

    def __init__(self, words: dict[str, int], trigrams: dict[str, int]) -> None:
        self.words = words
        self.total = max(1, sum(words.values()))
        self.trigrams = trigrams
        self.in_names: dict[str, list[str]] = defaultdict(list)
        for seen, meant in CONFUSIONS[:IN_NAMES]:
            self.in_names[seen].append(meant)
        self.by_seen: dict[str, list[str]] = defaultdict(list)
        for seen, meant in CONFUSIONS:
            self.by_seen[seen].append(meant)
        self.by_skeleton: dict[str, list[str]] = defaultdict(list)
        for w in words:
            self.by_skeleton[skeleton(w)].append(w)
        self.known: dict[str, tuple[str, float, int] | None] = {}
        self.tokens: dict[str, str | None] = {}

    def cost(self, word: str) -> float:
        n = self.words.get(word)
        return math.log(self.total / n) if n else math.inf

    def named(self, word: str) -> bool:
        """True if every three letters of a name occur in other names."""
        t = f"^{word.lower()}$"
        return len(word) > 3 and all(self.trigrams.get(t[i : i + 3], 0) > 1 for i in range(len(t) - 2))

    def _errors(self, seen: str, meant: str, most: int) -> int | None:
        """The fewest confusions that turn ``meant`` into ``seen``; null beyond ``most``."""
        reach = {(0, 0): 0}
        best: int | None = None
        order = [(0, 0)]
        while order:
            order.sort(reverse=True)
            at = order.pop()
            i, j = at
            n = reach[at]
            if i == len(seen) and j == len(meant):
                best = n if best is None else min(best, n)
                continue
            steps = [(i + 1, j + 1, 0)] if i < len(seen) and j < len(meant) and seen[i] == meant[j] else []
            if n < most:
                for size in (1, 2):
                    for m in self.by_seen.get(seen[i : i + size], ()) if i + size <= len(seen) else ():
                        if meant.startswith(m, j):
                            steps.append((i + size, j + len(m), 1))
            for x, y, e in steps:
                if n + e < reach.get((x, y), most + 1):
                    if (x, y) not in reach:
                        order.append((x, y))
                    reach[x, y] = n + e
        return best

    def meant(self, word: str) -> tuple[str, float, int] | None:
        """(word, cost, confusions): the dictionary word that was read as ``word`` with the fewest confusions, of those the cheapest: up to three, in short words two."""
        if word in self.known:
            return self.known[word]
        best: tuple[int, float, str] | None = None
        for w in self.by_skeleton.get(skeleton(word), ()):
            n = self._errors(word, w, 3 if len(word) > 6 else 2) if w != word else None
            if n and (best is None or (n, self.cost(w), w) < best):
                best = (n, self.cost(w), w)
        if len(self.known) > 200_000:
            self.known = {}
        self.known[word] = got = (best[2], best[1] + CONFUSED * best[0], best[0]) if best else None
        return got

    def misread(self, token: str) -> str | None:
        """What was meant by a misread token of one word, by its letters alone; null if it isn't misread."""
        if token in self.tokens:
            return self.tokens[token]
        if len(self.tokens) > 200_000:
            self.tokens = {}
        self.tokens[token] = got = self._misread(token)
        return got

    def _misread(self, token: str) -> str | None:
        bare = token.strip(AROUND)
        bare = re.sub(r"\[\d*$|^\d*\]", "", bare)
        if len(bare) < 2 or not any(c.isalpha() or c == "|" for c in bare) or re.search(r"[./\\_@#=<>{}()\[\]:]", bare):
            return None
        for part in re.split(r"['’\-‐‑]", bare):
            m = self._misread_part(part)
            if m is not None:
                return bare.replace(part, m)
        return None

    def _misread_part(self, part: str) -> str | None:
        low = part.lower()
        if len(part) < 2 or low in self.words or low.isdigit() or max(part) > "\u024f":  # the confusions are those of Latin letters
            return None
        letters = sum(c.isalpha() for c in part)
        odd = sum(not c.isalpha() for c in part)
        if not letters and "|" not in part:
            return None
        if odd and letters <= odd and not (letters and part.lower().strip("lio|0123456789") == ""):
            return None
        if odd and not letters:
            return None
        if odd and re.fullmatch(r"v?\d+[a-z]{1,3}|[A-Za-z]{1,3}\d+|\d+[ºªº°%]", part) and not re.fullmatch(r"[lIO|]\d+|\d+[lIO|]\d*", part):
            return None
        if re.fullmatch(r"(?=.*\d)[\dlIO|]+", part):
            return re.sub("[lI|]", "1", part).replace("O", "0")
        got = self.meant(low)
        if got:
            return self._cased(part, got[0])
        if ROMAN.fullmatch(part) and part.isupper():
            return None
        if part[0].isupper() or odd:
            if not odd and self.named(low):
                return None
            best = None
            for w in self._variants(low):
                if w.isalpha() and self.named(w) and (best is None or w < best):
                    best = w
            if best:
                return self._cased(part, best)
            if odd and part[0].isalpha() and letters > 3:
                return self._cased(part, low.translate({ord("1"): "l", ord("|"): "l", ord("0"): "o", ord("5"): "s"}))
        return None

    def _variants(self, w: str) -> Iterator[str]:
        for i in range(len(w)):
            for size in (1, 2):
                for m in self.in_names.get(w[i : i + size], ()) if i + size <= len(w) else ():
                    yield w[:i] + m + w[i + size :]

    @staticmethod
    def _cased(like: str, word: str) -> str:
        letters = [c for c in like if c.isalpha()]
        if len(letters) > 1 and all(c.isupper() for c in letters):
            return word.upper()
        return word[:1].upper() + word[1:] if letters and like[0].isupper() or like[:1] in "015|" and len(letters) > 1 and letters[0].isupper() else word

    def kinds(self, lines: list[str], title: str | None, marked: bool) -> list[set[str]] | None:
        """Kinds of each line; null if the text isn't scanned."""
        if not marked and (not wrapped(lines) or any(FENCED.match(x) or TABLE.fullmatch(x) for x in lines) or 3 * len([x for x in lines if x.strip()]) > sum(len(x.split()) for x in lines)):
            return None
        width = max(len(x.rstrip()) for x in lines) if lines else 0
        kinds: list[set[str]] = [set() for _ in lines]
        key = fold(title) if title else ""
        keyless = fold(re.sub(r"^\w+\s+\d+\s*:\s*", "", title)) if title else ""
        numbers: dict[int, tuple[int, bool]] = {}
        heads: dict[int, int | None] = {}
        text = [i for i, x in enumerate(lines) if x.strip()]
        for i in text:
            x = lines[i].strip()
            if TABLE.fullmatch(x):
                continue
            m = NUMBER.fullmatch(x)
            if m and (v := value(m["n"])) is not None and (m["n"].isdigit() or ROMAN.fullmatch(m["n"]) or re.search(r"\d", x)):
                plain = not (m["word"] or m["of"] or m["lead"] or m["tail"]) and any(c.isdigit() for c in m["n"])
                numbers[i] = (v, plain)
                continue
            for p in NUMBERED:
                h = p.fullmatch(x)
                if h and value(h["n"]) is not None and LETTERS.search(h["t"]) and not ENDS.search(h["t"]) and len(x) < max(60, 0.9 * width) and ("|" in h["gap"] or len(h["gap"]) > 1) and (any(c.isdigit() for c in h["n"]) or ROMAN.fullmatch(h["n"])):
                    heads[i] = value(h["n"])
                    break
            else:
                f = fold(x)
                if key and f and f in (key, keyless):
                    heads[i] = None
                elif self._ornate(x, width):
                    heads[i] = None
        styled = [v for v, plain in numbers.values() if not plain]
        bare = [i for i, (_, plain) in numbers.items() if plain]
        near = {v + k for v in [*(n for n in heads.values() if n is not None)] for k in (-1, 0, 1)}
        accepted = {i for i, (_, plain) in numbers.items() if not plain}
        if bare and (not styled or near):
            run = self._chain([(i, numbers[i][0]) for i in bare], near)
            if not run and not styled:
                run = {i for i in bare if i == text[-1] or self._breaks(lines, i)}
                if len(run) > 1:
                    last = max(run)
                    run = {i for i in run if abs(numbers[i][0] - numbers[last][0]) <= len(run)}
            accepted |= run
        for i in accepted:
            kinds[i].add("page_number")
        repeated = Counter(fold(self._head_text(lines[i])) for i in heads)
        for n, i in enumerate(text):
            x = lines[i].strip()
            if i in numbers or i in heads or TABLE.fullmatch(x):
                continue
            top = n == 0 or text[n - 1] in accepted or "\f" in "".join(lines[text[n - 1] : i + 1])
            short = len(x) < (0.8 if top else 0.6) * width and len(x) < 60
            first = next((c for c in x if c.isalnum()), "")
            if fold(x) in repeated or short and not ENDS.search(x) and (first.isupper() or first.isdigit() and not first.islower()) and LETTERS.search(x) and self._stands_apart(lines, text, n, top, width):
                heads[i] = None
        if not marked and not accepted and not heads and not any(self._cut(lines, i) for i in text):
            if not any(self.misread(w) for i in text for w in lines[i].split()):
                return None
        for i in heads:
            kinds[i].add("header")
        body = [i for i in text if not kinds[i] and i not in numbers]
        for piece in self.decode(lines, body):
            for line, kind in piece.marks:
                kinds[line].add(kind)
        return kinds

    @staticmethod
    def _head_text(line: str) -> str:
        for p in NUMBERED:
            if h := p.fullmatch(line.strip()):
                return h["t"]
        return line

    @staticmethod
    def _ornate(x: str, width: int) -> bool:
        """A short line between ornaments, or in capitals, or with its letters apart."""
        inner = x.strip(ORNAMENT)
        if not inner or len(x) > 0.95 * width and width > 50 or ENDS.search(inner):
            return False
        if x[0] in "—–-~*=[|" and x[-1] in "—–-~*=]|" and len(x) < 70:
            return True
        letters = [c for c in inner if c.isalpha()]
        if len(letters) > 3 and sum(c.isupper() for c in letters) >= 0.85 * len(letters):
            return True
        parts = inner.split()
        return len(parts) > 4 and all(len(p) == 1 for p in parts)

    @staticmethod
    def _chain(found: list[tuple[int, int]], near: set[int]) -> set[int]:
        """Bare numbers that go on one by one, or go with those in headers."""
        out = {i for i, v in found if v in near}
        for k, (i, v) in enumerate(found):
            for j, w in found[k + 1 :]:
                if 0 < w - v <= 2:
                    out |= {i, j}
        return out

    @staticmethod
    def _breaks(lines: list[str], i: int) -> bool:
        before = next((lines[k].strip() for k in range(i - 1, -1, -1) if lines[k].strip()), "")
        return bool(before) and not ENDS.search(before)

    @staticmethod
    def _stands_apart(lines: list[str], text: list[int], n: int, top: bool, width: int) -> bool:
        """A short line that neither ends a paragraph nor goes on with one."""
        i = text[n]
        if top:
            nxt = text[n + 1] if n + 1 < len(text) else None
            return nxt is not None and (len(lines[i].strip()) < 0.6 * width or nxt > i + 1)
        before, after = lines[text[n - 1]], lines[text[n + 1]] if n + 1 < len(text) else ""
        return bool(after) and len(before.rstrip()) > 0.5 * width or text[n - 1] < i - 1

    @staticmethod
    def _cut(lines: list[str], i: int) -> bool:
        x = lines[i].rstrip()
        return len(x) > 2 and x[-1] in HYPHENS and x[-2].isalpha()

    def _joined(self, line: str, nxt: str) -> bool:
        """True if the cheapest way over the hyphen at the line's end leaves it out."""
        if line[-1] in SURE_HYPHENS:
            return True
        head = re.search(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*$", line[:-1])
        tail = re.match(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*", nxt)
        if not head or not tail:
            return True
        a, b = head[0].lower(), tail[0].lower()
        whole, kept = a + b, f"{a}-{b}"
        join = self.cost(whole)
        if join == math.inf:  # known by its last part, as it was meant, or not at all
            join = UNKNOWN if self.words.get(re.split(r"['’\-]", whole)[-1]) else UNKNOWN + CONFUSED if self.meant(whole) else KEPT + BLANK
        keep = self.cost(kept)
        if keep == math.inf:
            one, two = a.rsplit("-", 1)[-1].rsplit("'", 1)[-1], b.split("-", 1)[0]
            keep = KEPT if one in self.words and two in self.words and len(one) > 3 and len(two) > 3 else KEPT + 2 * BLANK
        return join <= keep

    def _stand(self, token: str) -> float:
        """What a token costs as it stands."""
        bare = token.strip(AROUND)
        if not bare.isalpha():
            return 0.0  # numbers, names of things, marks: nothing to explain
        c = self.cost(bare.lower())
        return c if c < math.inf else UNKNOWN / 2 if not bare.islower() else UNKNOWN

    def _words_in(self, text: str) -> tuple[float, list[str], int] | None:
        """(cost, words, misread ones) of the cheapest way to read a stretch of letters as words without blanks; the first and the last may be misread."""
        low, n = text.lower(), len(text)
        best: list[dict[tuple[int, int], tuple[float, int, tuple[int, int], str]]] = [{} for _ in range(n + 1)]
        best[0][0, 0] = (0.0, 0, (0, 0), "")
        for i in range(n):
            for (k, bad), (c, _, _, _) in list(best[i].items()):
                if k == WORDS_IN:
                    continue
                for j in range(i + 1, min(n, i + 30) + 1):
                    w = low[i:j]
                    options = [(self.cost(w), w, 0)] if w in self.words and (len(w) > 1 or w in "aioyàé") else []
                    if bad < 2 and j - i > 3 and (i == 0 or j == n) and not options:
                        m = self.meant(w)
                        options = [(m[1], m[0], 1)] if m else []
                    for cost, word, e in options:
                        key, total = (k + 1, bad + e), c + cost
                        if key not in best[j] or total < best[j][key][0]:
                            best[j][key] = (total, i, (k, bad), word)
        if not best[n]:
            return None
        key = min(best[n], key=lambda x: (best[n][x][0] + BLANK * x[0], x))
        cost, at, words, bad = best[n][key][0], n, [], key[1]
        while at:
            _, before, up, word = best[at][key]
            words.append(word)
            at, key = before, up
        return cost, words[::-1], bad

    def decode(self, lines: list[str], body: list[int]) -> list[Piece]:
        """The text lines as one stream, decoded: pieces of it in order.

        Tokens of the dictionary stand. A stretch round unknown ones is read by the
        cheapest path; each step takes up to STRETCH tokens, as they stand, as one
        token was meant, or as one run of letters in which blanks are set anew.
        """
        stream: list[tuple[str, int, bool]] = []  # token, line, whether it was cut
        marks: dict[int, list[tuple[int, str]]] = {}
        carry, kept = "", False
        for a, i in enumerate(body):
            words = lines[i].split()
            cut = bool(carry)
            if carry:
                if kept and self._confused(words[0]):  # a compound's parts are whole words
                    marks.setdefault(len(stream), []).append((i, "misread"))
                words[0] = carry + words[0]
                carry = ""
            nxt = lines[body[a + 1]].lstrip() if a + 1 < len(body) else ""
            if self._cut(lines, i) and nxt[:1].islower():
                kept = not self._joined(lines[i].rstrip(), nxt)
                carry = words.pop() if kept else words.pop().rstrip(HYPHENS)
                if not kept:
                    marks.setdefault(len(stream) + len(words), []).append((i, "hyphen"))
                elif self._confused(carry):
                    marks.setdefault(len(stream) + len(words), []).append((i, "misread"))
            for k, w in enumerate(words):
                stream.append((w, i, cut and k == 0))
        if carry:
            stream.append((carry, body[-1], True))
        out: list[Piece] = []
        n = len(stream)
        odd = [self._odd(w) for w, _, _ in stream]
        at = 0
        while at < n:
            if not any(odd[at : at + STRETCH]):
                out.append(Piece([stream[at][0]], [stream[at][1]], marks.get(at, [])))
                at += 1
                continue
            end = at
            while end < n and any(odd[end : end + STRETCH]):
                end += 1
            end = min(n, end + STRETCH - 1)
            out += self._path(stream[at:end], odd[at:end], at, marks)
            at = end
        return out

    def _odd(self, token: str) -> bool:
        """True for tokens that no word explains as they stand."""
        if token.strip(AROUND).lower() in self.words:
            return False
        return self._confused(token) or (token.isalpha() and token.islower() and len(token) > 1)

    def _confused(self, token: str) -> bool:
        return self.misread(token) is not None

    def _path(self, part: list[tuple[str, int, bool]], odd: list[bool], offset: int, marks: dict) -> list[Piece]:
        """The cheapest path over a stretch of tokens."""
        n = len(part)
        cost = [0.0] + [math.inf] * n
        back: list[tuple[int, list[str], bool] | None] = [None] * (n + 1)

        def step(i: int, j: int, c: float, words: list[str], confused: bool) -> None:
            if cost[i] + c < cost[j] - 1e-9:
                cost[j], back[j] = cost[i] + c, (i, words, confused)

        for i in range(n):
            if cost[i] == math.inf:
                continue
            token = part[i][0]
            m = self.misread(token) if odd[i] else None
            if m is None:
                step(i, i + 1, self._stand(token), [token], False)
            else:  # as it was meant; as it stands it would be unknown
                got = self.meant(token.strip(AROUND).lower())
                step(i, i + 1, min(UNKNOWN - 1.0, got[1] if got else UNKNOWN / 2), [token.replace(token.strip(AROUND), m, 1)], True)
            for j in range(i + 1, min(n, i + STRETCH) + 1):
                if not any(odd[i:j]):
                    continue
                tokens = [t for t, _, _ in part[i:j]]
                first, last = tokens[0], tokens[-1]
                lead, tail = first[: len(first) - len(first.lstrip(AROUND))], last[len(last.rstrip(AROUND)) :]
                inner = "".join(tokens)[len(lead) : len("".join(tokens)) - len(tail) or None]
                if not inner.isalpha() or len(inner) < 4 or max(inner) > "\u024f" or not (inner.islower() or inner[1:].islower()):
                    continue
                got = self._words_in(inner)
                if got is None or (len(got[1]) == j - i and all(not o or self._confused(t) for o, t in zip(odd[i:j], tokens, strict=True))):
                    continue  # no blank moves
                c, words, bad = got
                # blanks that move: those between the tokens go, those between the words come
                moved = abs(len(words) - (j - i)) if "".join(tokens) != "".join(words) or len(words) != j - i else 0
                words = [self._cased(first[len(lead) :], words[0]), *words[1:]]
                words[0], words[-1] = lead + words[0], words[-1] + tail
                step(i, j, c + BLANK * max(1, moved), words, False)
        out: list[Piece] = []
        j = n
        while j:
            i, words, confused = back[j]
            own = [x for k in range(i, j) for x in marks.get(offset + k, [])]
            if confused and not part[i][2]:
                own.append((part[i][1], "misread"))
            out.append(Piece(words, [part[i][1]], own))
            j = i
        return out[::-1]

    def repair(self, lines: list[str], kinds: list[set[str]]) -> str:
        """Continuous paragraphs: headers and page numbers out, cut words joined, words and blanks as they were meant."""
        body = [i for i, x in enumerate(lines) if x.strip() and not kinds[i] & {"header", "page_number"}]
        if not body:
            return ""
        starts = self._paragraphs(lines, body, max(len(lines[i].rstrip()) for i in body))
        out: list[list[str]] = []
        begun = -1
        for piece in self.decode(lines, body):
            begins = [i for i in starts if begun < i <= piece.lines[0]]
            if begins or not out:
                out.append([])
                begun = max(begins, default=begun)
            out[-1] += piece.words
        return "\n\n".join(" ".join(p) for p in out if p)

    def _paragraphs(self, lines: list[str], body: list[int], width: int) -> set[int]:
        """Lines that begin a paragraph: the cheapest sequence of break and no break."""
        indents = [len(lines[i]) - len(lines[i].lstrip()) for i in body]
        common = Counter(indents).most_common(1)[0][0]
        cost = [0.0, math.inf]
        back: list[tuple[int, int]] = []
        for n in range(1, len(body)):
            a, b = lines[body[n - 1]].rstrip(), lines[body[n]].strip()
            score = 0.0  # for a break
            score += 3.0 if any(not lines[k].strip() for k in range(body[n - 1] + 1, body[n])) else -1.0
            score += 3.0 if indents[n] > common + 1 else 0.0
            score += 1.0 if ENDS.search(a) and a[-1] not in ",;" else -4.0
            score += -4.0 if b[:1].islower() else 0.5
            score += 1.0 if len(a) < 0.7 * width else -0.5
            new, step = [0.0, 0.0], [0, 0]
            for s in (0, 1):
                own = max(0.0, score) if s == 0 else max(0.0, -score)
                options = [(cost[p] + own + (1.5 if p == 1 and s == 1 else 0.0), p) for p in (0, 1)]
                new[s], step[s] = min(options)
            cost = new
            back.append((step[0], step[1]))
        state = 0 if cost[0] <= cost[1] else 1
        starts = {body[0]}
        for n in range(len(body) - 1, 0, -1):
            if state:
                starts.add(body[n])
            state = back[n - 1][state]
        return starts


def paper(kind: Column) -> Column:
    """True where a section may come from paper: of a PDF, or of no known kind."""
    return F.coalesce(F.lower(F.trim(kind)).isin("pdf", ""), F.lit(True))


def dictionary(sections: DataFrame) -> DataFrame:
    """(kind, word, n): words ('w') of the sections that don't come from paper, and three letters in a row ('t') of their names, by how many names have them.

    Words are counted as they are written first; a name is a word that is always
    written with a capital. Nothing depends on how rows are batched.
    """

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n: Counter = Counter()
            for t in pdf["content"]:
                n.update(RUN.findall(t))
            yield pd.DataFrame({"form": list(n), "n": list(n.values())})

    clean = sections.where(~paper(F.col("source_type")) & F.col("content").isNotNull()).select("content")
    forms = cut(clean.mapInPandas(part, "form string, n long").groupBy("form").agg(F.sum("n").alias("n")).withColumn("low", F.lower("form")))
    parts = F.when(F.contains("low", F.lit("-")), F.concat(F.array("low"), F.split("low", "-"))).otherwise(F.array("low"))
    words = forms.select(F.explode(parts).alias("word"), "n", "low").groupBy("word").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum("n").alias("n")).first().n or 0  # one number
    kept = words.where((F.col("n") >= 2) & (F.col("n") >= total * LEAST_SHARE)).select(F.lit("w").alias("kind"), "word", "n")
    capital = F.col("form").rlike(r"^\p{Lu}\p{Ll}{3,}$")
    names = forms.join(words, F.col("low") == F.col("word")).where(capital & (forms["n"] == words["n"])).select("low").distinct()
    padded = F.concat(F.lit("^"), F.col("low"), F.lit("$"))
    three = names.select(F.explode(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3)))).alias("word"))
    return kept.unionByName(three.groupBy("word").agg(F.count("*").alias("n")).where("n >= 2").select(F.lit("t").alias("kind"), "word", "n"))


def _reader_state(sections: DataFrame):
    words: dict[str, int] = {}
    trigrams: dict[str, int] = {}
    for r in dictionary(sections).toLocalIterator():  # bounded by LEAST_SHARE
        (words if r.kind == "w" else trigrams)[r.word] = r.n
    return sections.sparkSession.sparkContext.broadcast((words, trigrams))


def _sections(df: DataFrame) -> DataFrame:
    return df.where("section_id is not null and content is not null and content <> ''").where(paper(F.col("source_type"))).select("section_id", "title", "content", F.coalesce(F.lower(F.element_at("metadata", "ocr")) == "true", F.lit(False)).alias("marked"))


def line_kinds(df: DataFrame) -> DataFrame:
    """(section_id, line_no, kind) of the lines of scanned sections that are headers, page numbers, cut or misread.

    df: section_id, source_type, title, content, metadata. Null and empty
    contents and sections of other kinds of source give nothing; a section given
    twice counts once. Rows are read on their own; only kinds are shuffled.
    """
    state = _reader_state(df)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(*state.value)
        for pdf in batches:
            rows = []
            for key, title, content, marked in pdf.itertuples(index=False):
                kinds = reader.kinds(content.split("\n"), title, marked)
                rows += [(key, i, k) for i, ks in enumerate(kinds or (), 1) for k in sorted(ks)]
            yield pd.DataFrame(rows, columns=["section_id", "line_no", "kind"])

    return _sections(df).mapInPandas(part, "section_id long, line_no int, kind string").distinct()


def repaired(df: DataFrame) -> DataFrame:
    """(section_id, text) of scanned sections as continuous paragraphs; arguments as of ``line_kinds``."""
    state = _reader_state(df)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(*state.value)
        for pdf in batches:
            rows = []
            for key, title, content, marked in pdf.itertuples(index=False):
                lines = content.split("\n")
                kinds = reader.kinds(lines, title, marked)
                if kinds is not None:
                    rows.append((key, reader.repair(lines, kinds)))
            yield pd.DataFrame(rows, columns=["section_id", "text"])

    return _sections(df).mapInPandas(part, "section_id long, text string").dropDuplicates(["section_id"])
