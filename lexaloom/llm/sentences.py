"""Sentence units in texts of many languages and scripts.

Abbreviations, sentence starters and collocations are learned unsupervised and
per language from all documents by log-likelihood ratios; each period is then
classified with them. Other scripts end sentences with their own marks; Thai
parts them by blanks.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexaloom.session import cut

# Marks that end, open and close.
END = ".!?…。！？｡．؟۔।॥|"
FULL = "。！？｡।॥۔؟"  # end a sentence whatever follows
OPEN, CLOSE = "“„«「『〈《\"", "”“»」』〉》\""
PAIRS = {"“": "”", "„": "“", "«": "»", "「": "」", "『": "』", "《": "》", '"': '"'}
LIST = re.compile(r"[ \t]*(?:[-*•‣◦–+]|\(?\d{1,3}[.)、]|[a-zA-Z]\))[ \t]+\S")
HEADING = re.compile(r"[ \t]{0,3}#{1,6}[ \t]")
FENCE = re.compile(r"[ \t]*(```+|~~~+)")
MARK = re.compile(rf"[{re.escape(END)}]+(?:[\"”“»」』〉》’'）)\]】]|[   ](?=»)|\[\d{{1,4}}\]|[¹²³⁰⁴-⁹†‡*]+)*")
TOKEN = re.compile(r"\S+")
THAI = re.compile(r"[ก-ฺเ-๎]")
THAI_GAP = re.compile(r"[ \t ]+|\n")
# Thai words that go on with a sentence after a name or a number, and the marks for repeating and "etc.".
THAI_GOES_ON = ("และ", "แต่", "เพราะ", "ดังนั้น", "บอกว่า", "หรือ", "จึง", "ๆ", "ฯลฯ", "ครั้ง", "กับ")
QUOTE_GOES_ON = re.compile(r"(?:と|って|という)|[ \t\n]*\S+[ \t\n]+(?:ने|का कहना)\b|[ \t]*[,，،、;:—–-]")
# Scripts that tell a language of the ten, and common words of those in Latin script that the others hardly use.
SCRIPTS = [("ru", "Ѐ", "ӿ"), ("ja", "ぁ", "ヿ"), ("zh", "㐀", "鿿"), ("hi", "ऀ", "ॿ"), ("ar", "؀", "ۿ"), ("th", "ก", "๛")]
COMMON = {
    "en": "the of and to is that for with this are from by",
    "de": "der das und ist nicht ein eine mit den von zu auf für dem wird sind",
    "fr": "les des et est une du dans pour pas qui sur au avec",
    "es": "el los las y con por para del como más",
}
LANGUAGES = {*COMMON, *(name for name, _, _ in SCRIPTS)}
COMMON_WORDS = {w: name for name, ws in COMMON.items() for w in ws.split()}
#: A type must make up this share of its language's tokens, which bounds what is learned to a million entries a language.
LEAST_SHARE = 1e-6


def language(c: Column) -> Column:
    """The language of a label: first part, lower case; 'und' for null and blank."""
    s = F.lower(F.regexp_extract(F.trim(c), "^([A-Za-z]{2,3})", 1))
    return F.when(s != "", s).otherwise("und")


class _Scripts(dict):
    """The script of each character; "" where it is no letter."""

    def __missing__(self, c: str) -> str:
        self[c] = next((name for name, a, b in SCRIPTS if a <= c <= b), "latin") if c.isalpha() else ""
        return self[c]


SCRIPT_OF = _Scripts()
OTHER_SCRIPT = re.compile("[" + "".join(f"{a}-{b}" for _, a, b in SCRIPTS) + "]")


def spoken(text: str, label: str) -> str:
    """The language of ``text``: its label, unless that is 'und' or the text is plainly in another of LANGUAGES.

    A label whose script has under a fourth of the letters gives way to the language
    of the main script, and one of four languages in Latin script to another with
    over twice as many of its common words as the label's, five at least, or two
    where the label has none.
    """
    if label != "und" and label not in LANGUAGES:
        return label
    script = "latin"
    if not text.isascii() and (label not in COMMON or OTHER_SCRIPT.search(text)):
        n: Counter = Counter()
        for c, k in Counter(text).items():
            name = SCRIPT_OF[c]
            n[name] += 3 * k if name in ("zh", "ja") else k
        del n[""]
        if 5 * n["ja"] > n["zh"]:
            n["ja"], n["zh"] = n["ja"] + n["zh"], 0
        if n:
            script = max(n, key=lambda name: (n[name], name))
            own = label if label not in COMMON else "latin"
            if label != "und" and 4 * n[own] >= n.total():
                script = own
    elif label not in COMMON and not any(map(str.isalpha, text)):
        return label
    if script != "latin":
        return script
    n = Counter(map(COMMON_WORDS.get, text.lower().split()))
    del n[None]
    if not n:
        return label
    best = max(n, key=lambda name: (n[name], name))
    return label if label in COMMON and (n[best] < (5 if n[label] else 2) or n[best] <= 2 * n[label]) else best


def _observe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of a part: type with (kind 'p') and without ('w') period, capitalised type ('c') and at sure starts ('s'), with its period at the end of a block ('e'), pairs over a period ('b')."""
    for pdf in batches:
        n: Counter = Counter()
        tokens: defaultdict[str, Counter] = defaultdict(Counter)
        for text, label in zip(pdf["text"], pdf["lang"], strict=True):
            whole = spoken(text, label)
            for block in text.split("\n\n"):
                words = block.split()
                if not words or words[0][0] in "#`":
                    continue
                lang = whole if len(block) == len(text) else spoken(block, whole)
                tokens[lang].update(words)
                first = words[0].strip(OPEN)
                n[lang, "s", first.lower()] += 1
                if words[-1][-1] == ".":
                    n[lang, "e", words[-1].strip("()[]“”„«»\"',;:!?…")[:-1].lower()] += 1
                if "." in block:
                    for i, w in enumerate(words[:-1]):
                        if w[-1] == ".":
                            n[lang, "b", w.strip("(").lower() + " " + words[i + 1].strip(OPEN).lower()] += 1
                        elif w[-1] in "!?":
                            n[lang, "s", words[i + 1].strip(OPEN).lower()] += 1
        for lang, words in tokens.items():
            for w, k in words.items():
                bare = w.strip("()[]“”„«»\"',;:!?…")
                if not bare or not any(map(str.isalpha, bare)):
                    continue
                if bare[-1] == ".":
                    n[lang, "p", bare[:-1].lower()] += k
                    n[lang, "total p", ""] += k
                else:
                    n[lang, "w", bare.lower()] += k
                if bare[0].isupper():
                    n[lang, "c", bare.rstrip(".").lower()] += k
                n[lang, "total", ""] += k
        yield pd.DataFrame([(lang, kind, t, k) for (lang, kind, t), k in n.items()], columns=["lang", "kind", "type", "n"])


def log_likelihood(joint: Column, a: Column, b: Column, total: Column) -> Column:
    """Dunning's ratio of 'b follows a' against independence; negative where it is rarer than by chance."""

    def ll(k: Column, n: Column, p: Column) -> Column:
        q = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
        return k * F.log(q) + (n - k) * F.log(1 - q)

    a, b, k, t = a.cast("double"), b.cast("double"), joint.cast("double"), total.cast("double")
    p, p1, p2 = b / t, k / a, (b - k) / F.greatest(t - a, F.lit(1.0))
    ratio = -2 * (ll(k, a, p) + ll(b - k, t - a, p) - ll(k, a, p1) - ll(b - k, t - a, p2))
    return F.when(p1 >= p, ratio).otherwise(-ratio)


def learn(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, kind, type) of abbreviations ('abbr'), starters ('start') and collocations over a period ('pair'), learned per language.

    Counts are over all rows. Texts that are null count for nothing; an empty
    table gives an empty model.
    """
    read = docs.select(language(F.col(lang)).alias("lang"), F.col(text).alias("text")).where("text is not null and text <> ''")
    kinds = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k) for k in ("p", "w", "c", "s", "b", "e", "total", "total p")]
    n = read.mapInPandas(_observe, "lang string, kind string, type string, n long")
    wide = cut(n.groupBy("lang", "type").agg(*kinds))  # texts are read once
    totals = wide.where("type = ''").select("lang", F.col("total").alias("all_n"), F.col("total p").alias("all_p"))
    size = F.length(F.regexp_replace("type", r"\.", ""))
    x = wide.where("type <> '' and p + s + b > 1").join(F.broadcast(totals), "lang").where((F.col("p") + F.col("s") + F.col("b")) > F.col("all_n") * LEAST_SHARE)
    every = F.col("p") + F.col("w")
    dots = F.length("type") - size
    # an abbreviation seldom ends a block, a word that often ends sentences does
    penalty = F.pow(F.greatest(size, F.lit(2)).cast("double"), -12 * F.col("w") / F.greatest(every, F.lit(1)))
    score = log_likelihood(F.col("p"), every, F.col("all_p"), F.col("all_n")) * F.exp(-size.cast("double")) * (dots + 1) * penalty
    abbr = x.where((F.col("p") > 1) & (size > 0) & (F.col("e") * 20 <= F.col("p"))).where(score >= 0.3).select("lang", F.lit("abbr").alias("kind"), "type")
    shown = F.when(F.col("c") > 0, F.col("c")).otherwise(every)  # how often it stands with a capital, where it has one
    sure = F.broadcast(wide.groupBy("lang").agg(F.sum("s").alias("all_s")))  # a row a language
    start = x.where("s > 0").join(sure, "lang").where((log_likelihood(F.col("s"), F.greatest(shown, F.col("s")), F.col("all_s"), F.col("all_n")) > 30) & (F.col("s") > 0.1 * shown)).select("lang", F.lit("start").alias("kind"), "type")
    pair = x.where(F.col("b") > 1).select("lang", F.split("type", " ").alias("two"), "b", "all_n")
    left = wide.select("lang", F.concat("type", F.lit(".")).alias("l"), F.col("p").alias("nl"))
    right = wide.select("lang", F.col("type").alias("r"), (F.col("w") + F.col("p")).alias("nr"))
    pair = pair.select("lang", F.get("two", F.lit(0)).alias("l"), F.get("two", F.lit(1)).alias("r"), "b", "all_n").join(left, ["lang", "l"]).join(right, ["lang", "r"])
    pair = pair.where(log_likelihood(F.col("b"), F.greatest("nl", "b"), F.greatest("nr", "b"), F.col("all_n")) > 30)
    pair = pair.join(start.select("lang", F.col("type").alias("r")), ["lang", "r"], "left_anti").select("lang", F.lit("pair").alias("kind"), F.concat_ws(" ", "l", "r").alias("type"))
    return cut(abbr.unionByName(start).unionByName(pair).distinct())


class Splitter:
    """Classifies the marks of a text with what was learned: ``model``, or where ``models`` has it, that of the language of the line."""

    def __init__(self, model: list[tuple[str, str]], models: dict[str, list[tuple[str, str]]] | None = None) -> None:
        self.model, self.models = self._sets(model), {k: self._sets(m) for k, m in (models or {}).items()}
        self.known = set().union(self.model[0], *(m[0] for m in self.models.values()))

    @staticmethod
    def _sets(model: list[tuple[str, str]]) -> tuple[set[str], set[str], set[str]]:
        return tuple({t for k, t in model if k == kind} for kind in ("abbr", "start", "pair"))

    def _learned(self, text: str, a: int, at: int, b: int) -> tuple[set[str], set[str], set[str]]:
        """The abbreviations, starters and collocations for a mark of the block text[a:b]."""
        if not self.models:
            return self.model
        if self.block[:2] != (a, b):
            self.label = self.label or spoken(text, self.given)
            self.block = (a, b, spoken(text[a:b], self.label))
            self.line = (0, 0)
        if not self.line[0] <= at < self.line[1]:
            x, y = text.rfind("\n", a, at) + 1 or a, text.find("\n", at, b)
            y = b if y < 0 else y
            own = self.block[2] if (x, y) == (a, b) else spoken(text[x:y], self.block[2])
            self.line = (x, y, self.models.get(own, self.model))
        return self.line[2]

    def units(self, text: str, label: str = "und") -> list[tuple[int, int]]:
        """Units of ``text`` as offsets, in order, without surrounding blanks; ``label`` is its language as far as known."""
        if self.models:
            self.given, self.label, self.block = label, None, (0, 0)
        out: list[tuple[int, int]] = []
        at, fenced, block = 0, "", None
        lines = text.split("\n")
        for i, line in enumerate(lines):
            end = at + len(line)
            mark = FENCE.match(line)
            if fenced:
                if mark and mark[1][:3] == fenced:
                    fenced = ""
            elif mark:
                block = self._flush(text, block, out)
                fenced = mark[1][:3]
            elif not line.strip():
                block = self._flush(text, block, out)
            elif HEADING.match(line):
                block = self._flush(text, block, out)
                self._add(text, at, end, out)
            elif LIST.match(line) and not (block and block[2] != "item" and re.match(r"[ \t]*\d{1,3}\.", line) and self._midway(text[block[0] : block[1]])):
                block = self._flush(text, block, out)
                block = (at, end, "item")
            elif block and block[2] == "item":
                before = text[block[0] : block[1]].rstrip()
                if line[0] in " \t" or (line[0].islower() and before[-1] not in END):
                    block = (block[0], end, "item")
                else:
                    block = self._flush(text, block, out)
                    block = (at, end, "")
            else:
                block = (block[0], end, "") if block else (at, end, "")
            at = end + 1
        self._flush(text, block, out)
        return out

    def _midway(self, before: str) -> bool:
        """True if a hard-wrapped line breaks off in mid-sentence, so that a number at the next line's start is no list mark."""
        return before.rstrip()[-1:] not in END + ":" and len(before.rsplit("\n", 1)[-1]) > 40 and "\n" in before

    def _flush(self, text: str, block: tuple | None, out: list) -> None:
        if block:
            a, b, kind = block
            if kind == "item":
                self._add(text, a, b, out)
            else:
                for x, y in self._sentences(text, a, b):
                    self._add(text, x, y, out)

    @staticmethod
    def _add(text: str, a: int, b: int, out: list) -> None:
        part = text[a:b]
        bare = part.strip()
        if bare:
            a += len(part) - len(part.lstrip())
            out.append((a, a + len(bare)))

    def _quotes(self, text: str, a: int, b: int) -> list[tuple[int, int]]:
        """Quoted stretches, closing mark included; a quote that isn't closed in the block is none."""
        found, i = [], a
        opener = re.compile("[" + "".join(PAIRS) + "]")
        while m := opener.search(text, i, b):
            end = text.find(PAIRS[m[0]], m.end(), b)
            if end < 0:
                i = m.end()
                continue
            found.append((m.start(), end + 1))
            i = end + 1
        return found

    def _sentences(self, text: str, a: int, b: int) -> Iterator[tuple[int, int]]:
        quotes = self._quotes(text, a, b) if any(q in text[a:b] for q in PAIRS) else []
        start, q = a, 0
        thai = bool(THAI.search(text, a, b))
        cuts: list[int] = []
        opens = {x for x, _ in quotes}
        for m in MARK.finditer(text, a, b):
            end = next((i for i in range(m.start() + 1, m.end()) if i in opens), m.end())  # a mark that opens a quote closes none
            while q < len(quotes) and quotes[q][1] <= m.start():
                q += 1
            inside = q < len(quotes) and quotes[q][0] < m.start() < quotes[q][1]
            if inside and end < quotes[q][1]:
                continue
            if inside and not self._after_quote(text, start if not cuts else cuts[-1], quotes[q], end, b):
                continue
            if self._ends(text, a, cuts[-1] if cuts else a, b, text[m.start() : end], m.start(), end):
                cuts.append(end)
        if thai:
            cuts = sorted({*cuts, *self._thai(text, a, b)})
        for c in cuts:
            yield start, c
            start = c
        yield start, b

    def _after_quote(self, text: str, start: int, quote: tuple[int, int], end: int, b: int) -> bool:
        """True if the sentence may end with the quote that ends here."""
        if QUOTE_GOES_ON.match(text, end, b):
            return False
        lead = text[start : quote[0]].strip(" \n\t\"“”«»")
        inner = len(re.findall(r"[.!?。！？।؟]+(?=\s|[^\s\d])", text[quote[0] : end]))
        return bool(lead) or inner < 3 and len(re.findall(r"[!?。！？।؟]|\.(?=\s)", text[quote[0] + 1 : end - 1].rstrip(END))) == 0

    def _ends(self, text: str, block: int, a: int, b: int, marks: str, at: int, end: int) -> bool:
        """Whether the marks text[at:end] end a sentence."""
        i = end
        while i < b and text[i] in " \t\n  　":
            i += 1
        if i >= b:
            return True
        gap, nxt = i > end, text[i]
        if nxt in OPEN and i + 1 < b:
            k = i + 1
            while k < b and text[k] in "   ¿¡":
                k += 1
            follow = text[k] if k < b else nxt
        else:
            follow = text[i + 1] if nxt in "¿¡([" and i + 1 < b else nxt
        if "|" in marks:
            return at > a and "ऀ" <= text[at - 1] <= "ॿ"
        if "…" in marks or ".." in marks:
            others = set(marks) & set("!?。！？।؟")
            return bool(others) or gap and follow.isupper() and not follow.islower()
        if set(marks) & set(FULL):
            return nxt not in ",，、"
        if follow.islower() or nxt in ",;:，；：、—–-)" and not gap or nxt in ",;—–":
            return False
        if "!" in marks or "?" in marks:
            return gap or follow.isupper() or ord(follow) > 0x2E00
        # a period
        w = at
        while w > a and not text[w - 1].isspace():
            w -= 1
        word = text[w : at].lstrip("([{\"“„«¿¡")
        if not gap:
            if marks[-1] == "]" and not follow.islower():
                return True
            return follow.isupper() and len(word) > 1 and word.isalpha() and word[-1].islower() and w > a and i + 1 < b and (text[i + 1].islower() or text[i + 1].isspace()) or (ord(follow) > 0x590 and word[-1:].isalpha() and ord(word[-1]) > 0x590)
        e = i
        while e < b and not text[e].isspace():
            e += 1
        after = text[i:e].strip(OPEN + ",;:()[]¿¡").lower()
        if at > a and marks.startswith(".") and len(marks) > 1 and marks[1] in ")]" and text.rfind("(", a, w + 1) < 0:
            return True
        low = word.lower()
        short = (len(word) == 1 and word.isalpha()) or word.isdigit() and len(word) < 3 or ("." in word and all(len(p) < 3 and p.isalpha() for p in word.split(".") if p))
        if not short and low not in self.known:
            return True
        abbr, start, pair = self._learned(text, block, at, b)
        short = short or low in abbr
        if not short or ord(follow) > 0x590 and len(word) > 4:
            return True
        if nxt.isdigit():
            return False
        if f"{low}. {after}" in pair:
            return False
        return after.rstrip(".?!") in start

    @staticmethod
    def _thai(text: str, a: int, b: int) -> Iterator[int]:
        for m in THAI_GAP.finditer(text, a, b):
            i, e = m.start(), m.end()
            if i == a or e >= b or not (THAI.match(text[e])):
                continue
            p = i
            while p > a and not text[p - 1].isspace():
                p -= 1
            word = text[p:i]
            f = e
            while f < b and not text[f].isspace():
                f += 1
            after = text[e:f]
            if m[0] == "\n" and not THAI.match(text[i - 1]):
                continue
            if after.startswith(THAI_GOES_ON) or text[f : f + 5].lstrip().startswith("ฯลฯ") or text[i - 1] == "ๆ":
                continue
            if word == "ฯลฯ":
                yield i
            elif word[-1] == "." or word[-1].isdigit():
                continue
            elif THAI.match(word[-1]):
                yield i
            elif text[max(a, p - 4) : p].rstrip().endswith("กับ"):
                yield i


def sentence_units(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(key, start_char, end_char) of every sentence unit of every row, by what was learned in the language of each line.

    Null, empty and blank texts give no units; rows are handled on their own, so
    repeated rows give repeated units. Other columns are ignored.
    """
    model: dict[str, list[tuple[str, str]]] = {}
    for r in learn(docs, text, lang).toLocalIterator():  # bounded by LEAST_SHARE
        model.setdefault(r.lang, []).append((r.kind, r.type))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = Splitter([], shared.value)
        for pdf in batches:
            keys, starts, ends = [], [], []
            for k, t, label in zip(pdf["k"], pdf["t"], pdf["l"], strict=True):
                units = splitter.units(t, label)
                keys += [k] * len(units)
                starts += [u[0] for u in units]
                ends += [u[1] for u in units]
            yield pd.DataFrame({key: pd.Series(keys, dtype=pdf["k"].dtype), "start_char": pd.Series(starts, dtype="int64"), "end_char": pd.Series(ends, dtype="int64")})

    kind = docs.schema[key].dataType.simpleString()
    return docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"), language(F.col(lang)).alias("l")).mapInPandas(part, f"`{key}` {kind}, start_char long, end_char long")
