"""Text that was decoded with the wrong encoding, found and restored by description length.

A candidate is the text after a chain of repairs. One repair reads every maximal group of
characters that, in one wrong encoding, stands for a UTF-8 sequence as that sequence; groups that
do not are left, so names garbled only in part are repaired in part. Another reads the whole text's
bytes in a second single-byte encoding. A candidate costs the bits of its zstandard compression with
the dictionary of the best-fitting language, those of its letters, plus the bits of its chain; the
cheapest candidate wins and the text itself, with no chain, is one of them.

A question mark may stand for a character that is lost. Both readings of it are costed with the words
of all clean texts: as a mark beside the words it stands by, and as an open place of a longer word.

Work is done once per distinct text; texts that cannot be garbled never leave the JVM.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.session import cut, spread

#: Encodings in which UTF-8 is read by mistake, with the bits that naming them costs.
CODEC_BITS = {"cp1252": 4.0, "latin-1": 6.0, "cp437": 8.0, "cp850": 8.0, "mac_roman": 8.0, "cp1250": 8.0, "cp1251": 8.0}
#: The same where no-break spaces were made plain spaces afterwards.
SPACED_BITS = 8.0
#: Single-byte encodings in which the bytes of another were read, and what naming such a pair costs.
READ_AS, WRITTEN_IN = ("cp1252", "latin-1"), ("cp1251", "koi8_r", "cp1253", "cp1250", "cp850", "mac_roman")
PAIR_BITS = 28.0
#: Bits of a character that no clean text has, beside its rarity.
UNSEEN_BITS = 8.0
#: Bits of the first letter of a script that no clean text has, of each of its letters, and of a word of two scripts.
SCRIPT_BITS, LETTER_BITS, MIXED_BITS = 16.0, (4.0, 6.0), 24.0
#: The frequent letters of those scripts; they take the lesser of LETTER_BITS.
FREQUENT = frozenset("оеаинтсрвл" + "αοιετσςνηυρ")
#: Most bits of a letter that is a word by itself.
LONE_BITS = 12.0
#: A repair must save at least this many bits beside its own cost.
LEAST_GAIN = 0.0

#: Frequent words by which a name's language is told, for the choice of training texts.
LANGUAGE_WORDS = {
    "en": "at of in from the for plant farm organic mix conventional imported storage supply grade class dried treatment market".split(),
    "de": "ab für aus bei hof werk durchschnitt entsorgung gekühlt getrocknet import ökolandbau großhandel und von".split(),
    "fr": "de la à le du en au ferme usine moyen agriculture séché élimination départ importé coupé par".split(),
    "pt": "em na do categoria média nacional origem extra grão de".split(),
}


def _table(codec: str) -> dict[int, str]:
    """byte -> character; bytes the codec leaves open stand for themselves, as lenient readers have it."""
    out = {}
    for b in range(128, 256):
        try:
            out[b] = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            out[b] = chr(b)
    return out


@lru_cache(maxsize=None)
def _codec(codec: str, spaced: bool) -> tuple[re.Pattern, dict[str, int]]:
    table = _table(codec)
    back = {c: b for b, c in reversed(table.items())}
    more = ""
    if spaced and table[0xA0] == "\xa0":  # the sequences of à, a no-break space and the dagger of a second garbling
        back[" "] = 0xA0
        more = f"[{table[0xC2]}{table[0xC3]}] |{table[0xE2]}{re.escape(table[0x80])} |"
    cls = lambda lo, hi: "[" + "".join(re.escape(table[b]) for b in range(lo, hi + 1)) + "]"
    tail = cls(0x80, 0xBF)
    return re.compile(f"(?:{more}{cls(0xC2, 0xDF)}{tail}|{cls(0xE0, 0xEF)}{tail}{{2}}|{cls(0xF0, 0xF4)}{tail}{{3}})+"), back


def reread(text: str, codec: str, spaced: bool = False) -> str:
    """Every group of characters that is UTF-8 in ``codec``, read as UTF-8."""
    pattern, back = _codec(codec, spaced)

    def fix(m: re.Match) -> str:
        try:
            return bytes(back[c] for c in m[0]).decode("utf-8")
        except UnicodeDecodeError:
            return m[0]

    return pattern.sub(fix, text)


def reread_whole(text: str, read_as: str, written_in: str) -> str | None:
    """The text's bytes in ``read_as``, read in ``written_in``; None where they cannot be."""
    try:
        return text.encode(read_as).decode(written_in)
    except UnicodeError:
        return None


def candidates(text: str, spaced: bool = True) -> dict[str, tuple[float, tuple[str, ...]]]:
    """Reachable text -> (bits of the cheapest chain, chain); the text itself has no chain.

    Chains are followed to their end: every repair of a group makes the text shorter.
    """
    found: dict[str, tuple[float, tuple[str, ...]]] = {text: (0.0, ())}
    front = [text]
    while front:
        new = []
        for t in front:
            cost, chain = found[t]
            for codec, bits in CODEC_BITS.items():
                better = reread(t, codec)
                steps = [(better, bits, codec)]
                if spaced and " " in t and (loose := reread(t, codec, True)) != better:
                    steps.append((loose, bits + SPACED_BITS, f"{codec}, spaces"))
                for text_, more, name in steps:
                    if text_ != t and cost + more < found.get(text_, (float("inf"),))[0]:
                        found[text_] = (cost + more, (*chain, name))
                        new.append(text_)
        front = new
    if spaced and any(c in _LATIN for c in text):
        for a in READ_AS:
            for b in WRITTEN_IN:
                t = reread_whole(text, a, b)
                if t is not None and t not in found:
                    found[t] = (PAIR_BITS, (f"{a} for {b}",))
    return found


_LATIN = frozenset(chr(c) for c in range(0xC0, 0x100)) | frozenset("ŠŽœšžŸƒ")


@lru_cache(maxsize=None)
def script(c: str) -> str:
    """The script of a letter, by its name; ``""`` for other characters."""
    return unicodedata.name(c, "").split(" ")[0] if c.isalpha() else ""


def language(text: str) -> str:
    words = re.findall(r"\w+", text.lower())
    return max(LANGUAGE_WORDS, key=lambda g: (sum(w in LANGUAGE_WORDS[g] for w in words), g == "en"))


def train(texts: list[str], size: int = 16_384, least: int = 40) -> dict[str, bytes]:
    """A zstandard dictionary per language; a language with too few texts shares the one of all."""
    groups: dict[str, list[str]] = {}
    for t in texts:
        groups.setdefault(language(t), []).append(t)
    return {name: train_one([t.encode() for t in group], size) for name, group in [*sorted(groups.items()), ("all", texts)] if len(group) >= least}


def train_one(texts: list[bytes], size: int = 16_384) -> bytes:
    try:
        return zstd.train_dictionary(size, texts).as_bytes()
    except zstd.ZstdError:  # too little to train on: the texts themselves are the dictionary
        return b"\n".join(texts)[-size:]


PIECE, MERGED = 64, 64  #: bytes of the pieces that dictionaries are merged from, dictionaries merged at once
_TABLES = (b"\x37\xa4\x30\xec", 512)  #: how a trained dictionary begins, and about how many bytes its tables have


def merge(dictionaries: list[bytes]) -> bytes:
    """One dictionary trained on the contents of several, so on what many of them hold."""
    start = lambda d: _TABLES[1] if d.startswith(_TABLES[0]) and len(d) > 2 * _TABLES[1] else 0
    return train_one([d[i : i + PIECE] for d in dictionaries for i in range(start(d), len(d), PIECE)])


def trained(texts: DataFrame, rows: int, least: int = 40) -> dict[str, bytes]:
    """The dictionaries of :func:`train` from all of ``texts`` (text), distinct.

    Each language's texts are dealt by hash to groups of about ``rows``; every group is trained by
    itself, then the dictionaries are merged until one is left. Collected: one per language.
    """

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"text": b["text"], "name": [language(t) for t in b["text"]]})

    told = cut(texts.select("text").mapInPandas(tell, "text string, name string"))
    told = told.unionByName(told.withColumn("name", F.lit("all")))
    sizes = {r.name: r.n for r in told.groupBy("name").agg(F.count("*").alias("n")).collect() if r.n >= least}  # one row per language
    parts = {name: -(-n // rows) for name, n in sizes.items()}
    if not parts:
        return {}
    k = F.create_map(*(F.lit(x) for name, n in parts.items() for x in (name, n)))
    dealt = told.where(F.col("name").isin(list(parts))).withColumn("part", F.pmod(F.xxhash64("text"), k[F.col("name")].cast("bigint")))
    one = "name string, part bigint, dictionary binary"

    def learn(b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"name": b["name"].iloc[:1], "part": b["part"].iloc[:1], "dictionary": [train_one([t.encode() for t in sorted(b["text"])])]})

    def join(b: pd.DataFrame) -> pd.DataFrame:
        every = b.sort_values("part")["dictionary"].tolist()
        return pd.DataFrame({"name": b["name"].iloc[:1], "part": b["part"].iloc[:1] // MERGED, "dictionary": [every[0] if len(every) == 1 else merge(every)]})

    now, most = cut(dealt.groupBy("name", "part").applyInPandas(learn, one)), max(parts.values())
    while most > 1:
        now, most = cut(now.groupBy("name", F.floor(F.col("part") / MERGED).alias("up")).applyInPandas(join, one)), -(-most // MERGED)
    return {r.name: bytes(r.dictionary) for r in now.orderBy("name").collect()}


def seen_letters(texts: Iterable[str]) -> Counter:
    """How often each character beyond ASCII stands in the texts, and, after a zero byte, each that is a word by itself."""
    seen: Counter = Counter()
    for t in texts:
        if not t.isascii():
            seen.update(c for c in t if c > "\x7f")
            seen.update("\x00" + w for w in t.split() if len(w) == 1 and w > "\x7f")
    return seen


def alphabet(texts: list[str]) -> dict[str, float]:
    """Bits of each character beyond ASCII, from its frequency in clean texts; ``""`` is any other."""
    return rarity(seen_letters(texts))


def rarity(seen: Counter) -> dict[str, float]:
    """The bits of :func:`alphabet` from the counts of :func:`seen_letters`."""
    total = sum(n for c, n in seen.items() if len(c) == 1) + len(seen) + 1
    return {c: -math.log2((n + 1) / total) for c, n in seen.items()} | {"": -math.log2(1 / total) + UNSEEN_BITS}


class Coder:
    """Description lengths: the compressed text, and the characters beyond ASCII it calls for.

    The second term makes up for zstandard's whole bytes, which a single strange letter in a short
    name does not move.
    """

    def __init__(self, dictionaries: dict[str, bytes], letters: dict[str, float]) -> None:
        self.letters = letters
        kinds = [zstd.ZstdCompressionDict(b) for b in dictionaries.values()] or [None]
        params = zstd.ZstdCompressionParameters.from_level(19, source_size=128, dict_size=16384, format=zstd.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.compressors = [zstd.ZstdCompressor(dict_data=k, compression_params=params) if k else zstd.ZstdCompressor(compression_params=params) for k in kinds]

    def bits(self, text: str) -> float:
        return self.packed(text) + self.strange(text)

    def packed(self, text: str) -> float:
        """Bits of the compressed text."""
        raw = text.encode("utf-8", "surrogatepass")
        return 8.0 * min(len(c.compress(raw)) for c in self.compressors)

    def strange(self, text: str) -> float:
        """Bits of the characters beyond ASCII."""
        total, new = 0.0, set()
        for c in text:
            if c > "\x7f":
                own = self.letters.get(c)
                if own is None and script(c) in ("CYRILLIC", "GREEK"):
                    new.add(script(c))
                    own = LETTER_BITS[c.lower() not in FREQUENT]
                total += self.letters[""] if own is None else own
        total += SCRIPT_BITS * len(new)
        if not text.isascii():
            for word in text.split():
                if len(word) == 1 and word > "\x7f":
                    total += min(self.letters.get("\x00" + word, LONE_BITS), LONE_BITS)
                if not word.isascii() and len({x for c in word if (x := script(c)) in ("LATIN", "CYRILLIC", "GREEK")}) > 1:
                    total += MIXED_BITS
        return total


#: Characters that no clean name has: controls, replacement marks.
_LOST = re.compile("[�]|[\x80-\x9f]")


def restore(text: str, coder: Coder) -> tuple[str | None, float]:
    """(original, bits saved), ``""`` where characters are lost, None where the text is not garbled.

    Question marks are left as they are, see :func:`marks_lost`.
    """
    found = candidates(text)
    if len(found) == 1:
        return ("" if "\ufffd" in text else None), 0.0
    # the cheapest by chain and letters first: others are compressed only while these alone do not cost more
    order = sorted((coder.strange(t) + chain[0], len(chain[1]), t) for t, chain in found.items())
    best, own = text, coder.bits(text)
    least = own
    for floor, steps, t in order:
        if t == text or floor >= least:
            continue
        cost = coder.packed(t) + floor
        if cost < least or (cost == least and steps < len(found[best][1])):
            best, least = t, cost
    gain = own - least
    if best == text or gain < LEAST_GAIN:
        return ("" if "\ufffd" in text else None), 0.0
    return ("" if _LOST.search(best) else best), gain


# --- question marks ----------------------------------------------------------------------------

#: Bits of a plain question mark by its place: at the end of a clause, before a word that goes on, between or before letters, by itself.
MARK_BITS = {"end": 2.0, "on": 5.0, "in": 14.0, "before": 9.0, "alone": 12.0}
LOST_BITS = 5.0  #: that a character is lost
#: Bits of a word that no clean text has, of each of its letters, and what an open place adds to it.
WORD_BITS, EACH_BITS, OPEN_BITS = 14.0, 2.0, 8.0


def word_list(text: str) -> list[str]:
    """Words in lower case; signs beyond ASCII that stand in names count as words or parts of them."""
    return re.findall(r"[^\s!-/:-@\[-`{-~]+", text.lower())


def marked(text: str) -> list[tuple[str, str, str, str]]:
    """(word before, word after, the word with an open place, place) of each question mark or run of them."""
    out = []
    s = text.lower()
    for m in re.finditer(r"([^\s!-/:-@\[-`{-~]*)(\?+)([^\s!-/:-@\[-`{-~]*)", s):
        left, right = m[1], m[3]
        rest = s[m.end() :].lstrip()
        if left and right:
            place = "in"
        elif right:
            place = "before"
        elif left:
            place = "end" if not rest or text[m.end() :].lstrip()[:1].isupper() or not rest[0].isalnum() else "on"
        else:
            place = "end" if not rest else "alone"
        out.append((left, right, f"{left}?{right}", place))
    return out


def mark_is_lost(left: str, right: str, place: str, n_left: int, n_right: int, n_open: int, total: int) -> bool:
    """Whether an open place of a longer word explains a question mark better than a mark beside words.

    n_*: how often clean texts have the words, and words that fit the open place with a character
    beyond ASCII.
    """

    def bits(word: str, n: int) -> float:
        if not word:
            return 0.0
        known = -math.log2(n / (total + 1)) if n else math.inf
        return min(known, 6.0 + 2.0 * len(word)) if word.isdigit() else min(known, WORD_BITS + EACH_BITS * len(word))

    plain = bits(left, n_left) + bits(right, n_right) + MARK_BITS[place]
    whole = -math.log2(n_open / (total + 1)) if n_open else math.inf
    opened = LOST_BITS + min(whole, WORD_BITS + EACH_BITS * (len(left) + len(right) + 1) + OPEN_BITS)
    return opened < plain


def marks_lost(texts: DataFrame, clean_texts: DataFrame) -> DataFrame:
    """The distinct texts of ``texts`` (text) in which some question mark stands for a lost character.

    clean_texts: (text), whose words are counted, all of them; only the words the marks ask for are
    joined. No table is collected but the number of words.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(t, *m) for t in b["text"] for m in marked(t)]
            yield pd.DataFrame(rows, columns=["text", "left", "right", "open", "place"])

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            forms: Counter = Counter()
            for t in b["text"]:
                for w in word_list(t):
                    forms[w] += 1
                    if not w.isascii():
                        holes = {f"{w[:i]}?{w[i + 1 :]}" for i, c in enumerate(w) if c > "\x7f"}
                        holes |= {f"{w[: m.start()]}?{w[m.end() :]}" for m in re.finditer(r"[^\x00-\x7f]+", w)}
                        forms.update(holes)
            yield pd.DataFrame({"form": list(forms), "n": list(forms.values())}).astype({"form": object, "n": "int64"})

    asked = cut(texts.mapInPandas(ask, "text string, left string, right string, open string, place string"))
    needed = asked.select(F.explode(F.array("left", "right", "open")).alias("form")).where("form != ''").distinct()
    told = cut(clean_texts.select("text").mapInPandas(tell, "form string, n bigint").groupBy("form").agg(F.sum("n").alias("n")))
    total = told.where(~F.contains("form", F.lit("?"))).agg(F.sum("n")).first()[0] or 0
    known = cut(told.join(needed, "form"))
    for c in ("left", "right", "open"):
        asked = asked.join(known.select(F.col("form").alias(c), F.col("n").alias(f"n_{c}")), c, "left")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.fillna({"n_left": 0, "n_right": 0, "n_open": 0})
            lost = [mark_is_lost(r.left, r.right, r.place, int(r.n_left), int(r.n_right), int(r.n_open), total) for r in b.itertuples(index=False)]
            yield b.loc[np.array(lost, bool), ["text"]]

    return asked.select("text", "left", "right", "place", "n_left", "n_right", "n_open").mapInPandas(judge, "text string").distinct()


def _hard(c) -> F.Column:
    """Texts that may be garbled: they have a character beyond ASCII or a question mark."""
    return c.rlike(r"[^\x00-\x7F]|\?")


def clean(text: str) -> bool:
    """No lost character, no repair candidate, and no first byte of a sequence as a word by itself (its second a blank)."""
    if text.isascii():
        return "?" not in text
    return "\ufffd" not in text and "?" not in text and len(candidates(text, spaced=False)) == 1 and not any(w in _LEADS for w in text.split())


_LEADS = frozenset(_table(c)[b] for c in CODEC_BITS for b in (0xC2, 0xC3))


def clean_letters(hard: DataFrame) -> Counter:
    """How often each character beyond ASCII stands in the texts of ``hard`` (text), clean ones all of them.

    Collected: one row per different character.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen = seen_letters(b["text"])
            yield pd.DataFrame({"letter": list(seen), "n": list(seen.values())}).astype({"letter": object, "n": "int64"})

    counts = hard.select("text").mapInPandas(count, "letter string, n bigint")
    return Counter({r.letter: r.n for r in counts.groupBy("letter").agg(F.sum("n").alias("n")).collect()})


def judged(hard: DataFrame) -> DataFrame:
    """(text, clean) of texts that may be garbled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"text": b["text"], "clean": np.array([clean(t) for t in b["text"]], bool)})

    return cut(spread(hard.select("text"), 5_000).mapInPandas(run, "text string, clean boolean"))


def restored(names: DataFrame, train_rows: int = 20_000) -> DataFrame:
    """(tab, rec_id, restored) of every garbled text of ``names`` (tab, rec_id, text).

    restored is empty where characters are lost. Nulls and empty texts are never garbled; every
    copy of a garbled text is reported; an empty table gives an empty result. Texts are read whole.

    train_rows: texts that a dictionary is trained on at once, about; those of all groups are merged, see
    :func:`trained`. Dictionaries, letters, words, detection and restoration cover every text.
    """
    names = names.select("tab", "rec_id", "text")
    distinct = cut(names.select("text").where("text is not null and text != ''").distinct())
    hard = cut(distinct.where(_hard(F.col("text"))))
    told = judged(hard)
    plain = told.where("clean").select("text").unionByName(distinct.where(~_hard(F.col("text"))))
    dictionaries, letters = trained(plain, train_rows), rarity(clean_letters(told.where("clean")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(dictionaries, letters)
        for b in batches:
            yield pd.DataFrame({"text": b["text"], "restored": [restore(t, coder)[0] for t in b["text"]]})

    read = cut(spread(hard, 5_000).mapInPandas(run, "text string, restored string"))
    fixed = read.where("restored is not null").select("text", "restored")
    asks = read.where(F.contains("text", F.lit("?")) & F.coalesce(F.col("restored") != "", F.lit(True)))
    if not asks.isEmpty():
        # question marks are judged in the restored text, by the words of all texts without them
        asks = cut(asks.select("text", F.coalesce("restored", "text").alias("now")))
        lost = marks_lost(asks.select(F.col("now").alias("text")).distinct(), plain).withColumnRenamed("text", "now")
        gone = cut(asks.join(lost, "now").select("text", F.lit("").alias("gone")))
        fixed = read.join(gone, "text", "left").select("text", F.coalesce("gone", "restored").alias("restored")).where("restored is not null")
    return names.where(_hard(F.col("text"))).join(cut(fixed), "text").select("tab", "rec_id", "restored")
