"""Benchmark decontamination by templates.

Numbers, units after a number and capitalised words become typed placeholders, words capitalised in a row being one name, so that a question with
other figures and names has the template of the original. Capitals decide what is a name, and copies may lose or gain them, so each window also
stands with its names, and with all its placeholders, as case-folded words. Windows are hash-joined in any of the three forms. Those of one document
and one item that lie about the same way against each other are put together, and count only if their slots agree: what is one value in the item
is one value in the document.

Where a copy has lost its capitals, or an item is mostly figures and signs, no window may be left for that. So each item with names or figures is
also looked for whole: its rarest run of words, figures and signs that holds no name of its own says where it may stand, and there all of it must fit,
any one to three words for a name, the same for the same (Wholes).
"""

from __future__ import annotations

import math
import re
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.cells import among
from eventloom.llm.common import begins, cut, shingle_hashes, stored

#: Units that count as such after a number. Fixed values.
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles metre metres meter meters kilometre kilometres kilometer kilometers centimetre centimetres centimeter centimeters "
    "mg g kg t oz lb lbs gram grams kilogram kilograms ton tons tonne tonnes ounce ounces pound pounds ml cl l litre litres liter liters gallon gallons pint pints cup cups "
    "s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years decade decades "
    "mph kmh kph hz khz mhz ghz w kw mw wh kwh v a j kj n pa kpa bar c f k degree degrees percent % b kb mb gb tb bit bits byte bytes "
    "usd eur gbp dollar dollars euro euros cent cents penny pence".split()
)
#: Words for numbers. Fixed values.
NUMBERS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())

NUMBER, UNIT, NAME = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"\0number", b"\0unit", b"\0name"))
#: Words that a task remembers; beyond them it begins anew.
KNOWN_WORDS = 250_000
#: Forms of a window: with all placeholders, with those of numbers and units, with none.
TEMPLATE, FIGURES, WORDS = range(3)
#: What a word is: any word, a number, a number with a unit, nothing but marks, a sign of arithmetic that stands alone.
WORD, PLAIN_NUMBER, WITH_UNIT, NOTHING, SIGN = range(5)
SIGNS = frozenset("+ - * / = < > ^ × ÷ − · ( )".split())
#: Flags of a word: it is a unit's name, it is capitalised, it ends a sentence.
IS_UNIT, CAPITAL, ENDS = 1, 2, 4
_NUMBER_WITH_UNIT = re.compile(r"([+-]?[\d.,/:]*\d)([^\W\d_]+|%)")
_FIGURE = re.compile(r"[+-]?\d[\d.,/:]*")
_EDGES = re.compile(r"^[^\w%+-]+|[^\w%]+$")
_TAIL = "".join(x for x in punctuation if x not in "%_")
_CLOSING = "\"')]}»”’"


class _Kinds(dict):
    """For each raw word its number in the tables: literal hash (of a number with a unit, the number's), the unit's, kind, flags and values."""

    def __init__(self):
        super().__init__()
        self.hash, self.last = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint64)
        self.kind, self.flags = np.zeros(1 << 12, np.int8), np.zeros(1 << 12, np.int8)
        self.value: list[tuple[str, ...]] = []

    def __missing__(self, raw: str) -> int:
        own = raw.rstrip(_TAIL)
        plain = own.isalpha()  # most words are letters with marks after them
        if not plain:
            own = _EDGES.sub("", raw).strip("_")
        low = own.casefold()
        kind, value = WORD, (low,)
        if not plain:
            m = _NUMBER_WITH_UNIT.fullmatch(low)
            if raw in SIGNS:
                kind, value = SIGN, (raw,)
            elif not re.search(r"\w|%", own):
                kind = NOTHING
            elif _FIGURE.fullmatch(low):
                kind = PLAIN_NUMBER
            elif m and m[2] in UNITS:
                kind, value = WITH_UNIT, m.groups()
        elif low in NUMBERS:
            kind = PLAIN_NUMBER
        v = len(self.value)
        if v == len(self.hash):
            self.hash, self.last, self.kind, self.flags = (np.concatenate([x, np.zeros_like(x)]) for x in (self.hash, self.last, self.kind, self.flags))
        self.hash[v] = xxhash.xxh64_intdigest(value[0])
        self.last[v] = xxhash.xxh64_intdigest(value[1]) if kind == WITH_UNIT else 0
        self.kind[v] = kind
        ends = raw.rstrip(_CLOSING)[-1:] in (".", "!", "?")
        self.flags[v] = IS_UNIT * (low in UNITS) | CAPITAL * (own[:1].isupper() and (own[1:].islower() or len(own) == 1)) | ENDS * ends
        self.value.append(value)
        self[raw] = v
        return v


class _Stream:
    """Template tokens of texts in a row, in one of the forms: hashes, which are placeholders, texts' numbers, and the words that each stands for."""

    def __init__(self, h, slot, doc, first, last):
        self.h, self.slot, self.doc, self.first, self.last = h, slot, doc, first, last


class _Templates:
    """The words of several texts in a row, and their template tokens in each form; with ``signs``, those of arithmetic are words too."""

    def __init__(self, kinds: _Kinds, column: pa.Array, signs: bool = False):
        lists = pc.ascii_split_whitespace(column)
        coded = lists.flatten().dictionary_encode()
        own = np.fromiter(map(kinds.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist()), np.int64, len(coded.dictionary))
        at = own[coded.indices.to_numpy()]
        offsets = lists.offsets.to_numpy()
        doc = np.repeat(np.arange(len(column), dtype=np.int32), np.diff(offsets))
        kind = kinds.kind[at]
        self.signed = np.unique(doc[kind == SIGN])  # texts with signs
        keep = (kind < NOTHING) | (kind == SIGN) if signs else kind < NOTHING
        # A sentence also ends with marks that stand alone after its last word.
        ends, own = kinds.flags[at] & ENDS > 0, np.flatnonzero(keep)
        alone = np.cumsum(ends & ~keep)
        ends = ends[own] | (alone[np.append(own[1:], len(at)) - 1] > alone[own]) if len(own) else ends[own]
        at, doc = at[keep], doc[keep]
        # A number with a unit is two tokens.
        if (kinds.kind[at] == WITH_UNIT).any():
            twice = np.where(kinds.kind[at] == WITH_UNIT, 2, 1)
            second = np.zeros(int(twice.sum()), bool)
            second[np.cumsum(twice)[twice == 2] - 1] = True
            at, doc, ends = (np.repeat(x, twice) for x in (at, doc, ends))
        else:
            second = np.zeros(len(at), bool)
        kind, flags = kinds.kind[at], kinds.flags[at]
        number = (kind == PLAIN_NUMBER) | (kind == WITH_UNIT) & ~second
        unit = second.copy()
        unit[1:] |= (flags[1:] & IS_UNIT > 0) & (kind[1:] == WORD) & number[:-1] & (doc[1:] == doc[:-1])
        name = (flags & CAPITAL > 0) & (kind == WORD) & ~unit
        literal = np.where(second, kinds.last[at], kinds.hash[at])
        figures = np.where(number, NUMBER, np.where(unit, UNIT, literal))
        self.kinds, self.at, self.second, self.doc = kinds, at, second, doc
        self.literal, self.figures, self.number, self.unit, self.name = literal, figures, number, unit, name
        self.starts = np.ones(len(at), bool)  # which words begin a sentence
        self.starts[1:] = ends[:-1] | (doc[1:] != doc[:-1])
        self.bounds = np.searchsorted(doc, np.arange(len(column) + 1))
        place = np.arange(len(at))
        more = np.zeros(len(at), bool)  # goes on with the name before it
        more[1:] = name[1:] & name[:-1] & ~ends[:-1] & (doc[1:] == doc[:-1])
        first = place[~more]
        last = np.append(first[1:], len(at))
        slot = number | unit
        self.forms = {
            WORDS: _Stream(literal, np.zeros(len(at), bool), doc, place, place + 1),
            FIGURES: _Stream(figures, slot, doc, place, place + 1),
            TEMPLATE: _Stream(np.where(name, NAME, figures)[first], (slot | name)[first], doc[first], first, last),
        }
        self.named = np.concatenate([[0], np.cumsum(name)])

    def said(self, i: int) -> str:
        return self.kinds.value[self.at[i]][-1 if self.second[i] else 0]

    def values(self, form: int, s: int, size: int) -> list[str]:
        """The values under the placeholders of a window."""
        x = self.forms[form]
        return [" ".join(map(self.said, range(x.first[i], x.last[i]))) for i in range(s, s + size) if x.slot[i]]

    def windows(self, form: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of the windows of ``size`` tokens within a text: of words, all; of other forms, those that hold more words than
        placeholders and are said by no other form."""
        x = self.forms[form]
        n = max(len(x.h) - size + 1, 0)
        ok = x.doc[:n] == x.doc[size - 1 : size - 1 + n]
        if form != WORDS:
            sums = np.concatenate([[0], np.cumsum(x.slot)])
            slots = sums[size : size + n] - sums[:n]
            ok &= (slots > 0) & (2 * slots < size)
            if form == FIGURES:
                ok &= self.named[size : size + n] > self.named[:n]
        starts = np.flatnonzero(ok)
        return starts, shingle_hashes(x.h, size)[starts] if len(starts) else np.empty(0, np.uint64)


#: Of a whole item: words of a run that says where it may stand, at most; words that must be left besides names and figures; words of a name.
ANCHOR, FIXED, ENOUGH, NAME_WORDS = 5, 4, 8, 3
#: A whole item is fitted against a stretch of a document as text, words between single spaces.
_NUMBER_TEXT, _WORD_TEXT = rf"(?:[+-]?\d[\d.,/:]*|{'|'.join(sorted(NUMBERS))})", r"[^\s\d][^\s]*"


class Wholes:
    """Items to be found whole: a pattern for each, and the hash of its anchor, size by size.

    A capitalised word is a name if it stands so within a sentence somewhere among the items, and otherwise, at the beginning of a sentence, if at
    least ENOUGH words are left without it; so an item's last few words always stand for themselves. Items with fewer than FIXED words and signs
    besides names and figures or with no word, with no names or figures, or with no two words in a row without a name, aren't looked for in this way.
    """

    def __init__(self, items: list[tuple[int | None, str]]):
        kinds = _Kinds()
        t = _Templates(kinds, pa.array([text for _, text in items], pa.string()), signs=True)
        inner = {t.said(i) for i in np.flatnonzero(t.name & ~t.starts).tolist()}
        self.found: dict[int, dict[int, list]] = {}  # by size and hash: (item's id, words, words before the anchor at most and after, pattern)
        runs: list[list[tuple]] = []
        counts: dict[tuple[int, int], int] = {}
        for d in range(len(items)):
            at = list(range(int(t.bounds[d]), int(t.bounds[d + 1])))
            sure = {i for i in at if t.name[i] and (not t.starts[i] or t.said(i) in inner)}
            maybe = {i for i in at if t.name[i]}
            fixed = lambda names, at=at: [i for i in at if i not in names and not t.number[i] and not t.unit[i]]
            names = maybe if len(fixed(maybe)) >= ENOUGH else sure
            slots = [i for i in at if i in names or t.number[i] or t.unit[i]]
            own: list[tuple] = []
            if slots and len(fixed(names)) >= FIXED and any(t.kinds.kind[t.at[i]] == WORD for i in fixed(names)):
                for size in range(2, ANCHOR + 1):
                    for k in range(len(at) - size + 1):
                        span = at[k : k + size]
                        if not names.intersection(span):
                            h = int(shingle_hashes(t.figures[span], size)[0])
                            own.append((size, h, k, sum(not t.number[i] and not t.unit[i] for i in span)))
                            counts[size, h] = counts.get((size, h), 0) + 1
            runs.append([(own, at, names)] if own else [])
        for (item_id, _), run in zip(items, runs, strict=True):
            for own, at, names in run:
                size, h, k, _ = max(own, key=lambda x: (min(x[3], 3), -counts[x[0], x[1]], x[3], -x[2]))
                held = sum(i in names for i in at) * (NAME_WORDS - 1)
                self.found.setdefault(size, {}).setdefault(h, []).append((item_id, len(at), k + held, len(at) - k + held, self._pattern(t, at, names)))
        self.sorted = {size: np.array(sorted(own), np.uint64) for size, own in self.found.items()}

    @staticmethod
    def _pattern(t: _Templates, at: list[int], names: set[int]) -> str:
        parts, groups, i = [], {}, 0
        while i < len(at):
            j = i + 1
            if at[i] in names:
                while j < len(at) and at[j] in names and not t.starts[at[j]]:
                    j += 1
                key, text = ("name", " ".join(t.said(x) for x in at[i:j])), _WORD_TEXT + rf"(?: {_WORD_TEXT}){{0,{NAME_WORDS - 1}}}?"
            elif t.number[at[i]]:
                key, text = ("number", t.said(at[i])), _NUMBER_TEXT
            elif t.unit[at[i]]:
                key, text = ("unit", t.said(at[i])), _WORD_TEXT
            else:
                key, text = None, re.escape(t.said(at[i]))
            if key and key in groups:
                text = f"(?P={groups[key]})"
            elif key:
                groups[key] = f"g{len(groups)}"
                text = f"(?P<{groups[key]}>{text})"
            parts.append(text)
            i = j
        return r"(?<!\S)" + " ".join(parts) + r"(?!\S)"

    def met(self, kinds: _Kinds, t: _Templates, column: pa.Array, patterns: dict[str, re.Pattern]):
        """(text's number, item's id, words) of the items in a column of texts, whose templates are ``t``. Texts with signs are read with them too."""
        yield from self.found_in(t, patterns)
        if len(t.signed):
            for d, item_id, words in self.found_in(_Templates(kinds, column.take(pa.array(t.signed)), signs=True), patterns):
                yield int(t.signed[d]), item_id, words

    def found_in(self, t: _Templates, patterns: dict[str, re.Pattern]):
        """The same for one way of reading, an item once for a text."""
        for size, known in self.sorted.items():
            n = len(t.figures) - size + 1
            if n <= 0:
                continue
            h = shingle_hashes(t.figures, size)
            hits = np.flatnonzero(among(h, known))
            hits = hits[t.doc[hits] == t.doc[hits + size - 1]]
            done: set[tuple[int, str]] = set()
            for i, own in zip(hits.tolist(), h[hits].tolist(), strict=True):
                d = int(t.doc[i])
                for item_id, words, before, after, pattern in self.found[size][own]:
                    if (d, pattern) in done:
                        continue
                    low, high = max(int(t.bounds[d]), i - before), min(int(t.bounds[d + 1]), i + after)
                    if pattern not in patterns:
                        patterns[pattern] = re.compile(pattern)
                    if patterns[pattern].search(" ".join(map(t.said, range(low, high)))):
                        done.add((d, pattern))
                        yield d, item_id, words


_SCHEMA = pa.schema([("id", pa.int64()), ("text_key", pa.int64()), ("size", pa.int32()), ("pos", pa.int64()), ("words", pa.int32()), ("h", pa.int64()), ("slots", pa.list_(pa.string())), ("n", pa.int64())])
_SPEC = "id long, text_key long, size int, pos long, words int, h long, slots array<string>, n long"


def _windows(table: DataFrame, id_col: str, text_col: str, size: int, wanted=None, sizes=None, wholes=None) -> DataFrame:
    """The windows of a table's texts in all forms; pos and words say where they lie among the text's n words. wanted: a broadcast of sorted
    hashes, others are left out. sizes: window lengths to take; None: ``size``, or the own length of a text with fewer tokens. wholes: a broadcast of
    Wholes; an item that a text holds is a row of size 0, with the item's words as n and its id in slots."""

    def emit(kinds, ids, keys, column, patterns):
        t = _Templates(kinds, column)
        if wholes is not None:
            for d, item_id, n in wholes.value.met(kinds, t, column, patterns):
                yield ids[d], keys[d], 0, 0, n, 0, [None if item_id is None else str(item_id)], n
        count = np.diff(t.bounds)
        for form, x in t.forms.items():
            lengths = np.diff(np.searchsorted(x.doc, np.arange(len(column) + 1)))
            for k in sorted({min(size, int(n)) for n in lengths if n}) if sizes is None else sizes:
                starts, h = t.windows(form, k)
                if sizes is None:
                    fit = np.minimum(lengths[x.doc[starts]], size) == k
                    starts, h = starts[fit], h[fit]
                if wanted is not None and len(starts):
                    known, coarse = wanted.value
                    maybe = np.flatnonzero(coarse[(h >> np.uint64(44)).astype(np.int64)])
                    maybe = maybe[known[np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)] == h[maybe]] if len(known) else maybe[:0]
                    starts, h = starts[maybe], h[maybe]
                for s, v in zip(starts.tolist(), h.view(np.int64).tolist(), strict=True):
                    d, low = int(x.doc[s]), int(x.first[s])
                    yield ids[d], keys[d], k, low - int(t.bounds[d]), int(x.last[s + k - 1]) - low, v, t.values(form, s, k), int(count[d])

    def run(batches):
        begins("decontamination")
        kinds, patterns = _Kinds(), {}
        for b in batches:
            ids, keys, column = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.string())
            weight = np.cumsum(pc.binary_length(column).to_numpy()).astype(np.int64)
            at, out = 0, []
            while at < len(ids):
                to = max(at + 1, int(np.searchsorted(weight, (weight[at - 1] if at else 0) + (1 << 21))))
                out.extend(emit(kinds, ids[at:to], keys[at:to], column.slice(at, to - at), patterns))
                at = to
                if len(kinds) > KNOWN_WORDS:
                    kinds = _Kinds()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(_SCHEMA)], schema=_SCHEMA)

    text = F.coalesce(F.col(text_col), F.lit(""))
    return table.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text")).mapInArrow(run, _SPEC)


#: Up to so many distinct benchmark windows (16 MB), tasks get their hashes and drop other windows before the join.
BROADCAST_WINDOWS = 2_000_000
#: Bytes of items' texts whose patterns go to the tasks at once.
WHOLE_BYTES = 4_000_000


def _agree(pairs: set[tuple[str, str]]) -> bool:
    """No value of the item has two in the document."""
    return len(pairs) == len({of for of, _ in pairs})


def _longest(covered: set[int]) -> int:
    return max((_run_from(covered, i) for i in covered if i - 1 not in covered), default=0)


def _run_from(covered: set[int], i: int) -> int:
    n = i
    while n in covered:
        n += 1
    return n - i


def judged(matches: list[tuple[int, int, int, tuple[tuple[str, str], ...]]], n: int, low: float = -math.inf, high: float = math.inf) -> tuple[float, int, int]:
    """(coverage, longest run, windows met) for the windows that an item of n words and a stretch of a document share, as (place in the item, words,
    place in the document, slots' pairs of values). The item's place in the document is from ``low`` to below ``high``.

    Windows lie on alignments, the difference of the two places. An alignment is put together with those not far off, as another name has more
    words, if all slots agree. Where they don't, and a window of the item is met in no way that agrees, only windows without slots count.
    The best such set decides.
    """
    by: dict[int, list] = {}
    for m in matches:
        by.setdefault(m[2] - m[0], []).append(m)
    pairs = {d: {p for m in own for p in m[3]} for d, own in by.items()}
    best = (0.0, 0, 0)
    for d0 in by:
        if not low <= d0 < high:
            continue
        near = sorted((d for d in by if abs(d - d0) <= max(4, n // 4)), key=lambda d: (abs(d - d0), d))
        known: set[tuple[str, str]] = set()
        took, left = [], []
        for d in near:
            if _agree(known | pairs[d]):
                known |= pairs[d]
                took += [(d, m) for m in by[d]]
            else:
                took += [(d, m) for m in by[d] if not m[3]]
                left += [m[0] for m in by[d] if m[3]]
        if not {m[0] for _, m in took}.issuperset(left):
            took = [(d, m) for d in near for m in by[d] if not m[3]]
        words = lambda own: {i for m in own for i in range(m[0], m[0] + m[1])}
        best = max(best, (len(words(m for _, m in took)) / n, _longest(words(m for d, m in took if d == d0)), len({m[0] for _, m in took})))
    return best


def _with_rarity(items: DataFrame, share: float, run: int) -> DataFrame:
    """items with ``rare``: whether a window proposes its item. Windows are taken from those that most items hold on; as long as what they cover together
    is less than ``share`` of the item's words and has no ``run`` in a row, no document holds the item by these alone. The others propose it."""
    held = items.groupBy("h", "size").agg(F.count_distinct("id", "text_key").alias("held"))
    schema = pa.schema([*_SCHEMA, ("rare", pa.bool_())])

    def mark(table: pa.Table) -> pa.Table:
        n, pos, words = table.column("n")[0].as_py(), table.column("pos").to_numpy(), table.column("words").to_numpy()
        rare, covered = np.ones(table.num_rows, bool), set()
        for i in np.lexsort((pos, -table.column("held").to_numpy())).tolist():
            covered.update(range(pos[i], pos[i] + words[i]))
            if len(covered) >= share * n or _longest(covered) >= run:
                break
            rare[i] = False
        return table.drop_columns(["held"]).append_column("rare", pa.array(rare)).cast(schema)

    return items.join(held, ["h", "size"]).select(*_SCHEMA.names, "held").groupBy("id", "text_key").applyInArrow(mark, f"{_SPEC}, rare boolean")


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 5, share: float = 0.8, run: int = 13) -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched, coverage): the documents that hold an item of ``benchmark``(item_id, text), with that item.

    n_windows: the item's windows of ``size`` words (one, of all its words, if it has fewer); with placeholders, only windows with more words than
    those are met, others word by word. n_matched: those found together in one stretch of the document, in any form, with slots that agree
    (judged()). coverage: the share of the item's words that lie in such windows, so that an edited word costs one and not all windows over
    it. A document holds an item if coverage is ``share`` or more, or if ``run`` words in a row lie in such windows of one alignment. White space,
    case and marks at the ends of words don't matter. An item that stands whole in a document, with other names and figures (Wholes), has all its words
    covered. Null and empty texts and texts without words match nothing; repeated rows of a doc_id give one
    row for an item; items with the same template each give rows; null ids come back null. No rows, no result.

    Items' windows are few against documents' ones: while they number at most BROADCAST_WINDOWS, tasks drop other windows before the join,
    beyond that all windows are joined. The join and what follows are the same. Patterns of whole items go to the tasks by blocks of WHOLE_BYTES of text;
    documents are read once for each block, a single one together with the windows. Matches are judged by stretches of three times the item's length,
    each beginning a length after the one before and judging the copies that begin in its middle third: it sees these whole, a task holds no
    more of a long document, and an item that stands often in it is met.
    """
    spark = docs.sparkSession
    items = cut(_with_rarity(_windows(benchmark, "item_id", "text", size), share, run))
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # at most ``size`` of them
    wanted = None
    distinct = items.select("h").distinct()
    if distinct.count() <= BROADCAST_WINDOWS:
        known = np.sort(distinct.toArrow().column(0).to_numpy().view(np.uint64))
        coarse = np.zeros(1 << 20, bool)
        coarse[(known >> np.uint64(44)).astype(np.int64)] = True
        wanted = spark.sparkContext.broadcast((known, coarse))
    right = items.select(F.col("id").alias("item_id"), F.col("text_key").alias("item_key"), F.col("pos").alias("item_pos"), F.col("words").alias("item_words"), "size", "h", F.col("slots").alias("item_slots"), F.col("n").alias("n_words"), "rare")
    whole = benchmark.select(F.col("item_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).where("text != ''").distinct()
    blocks = math.ceil((whole.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / WHOLE_BYTES)

    def block(k: int):
        own = whole.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k)
        return spark.sparkContext.broadcast(Wholes([(r["id"], r["text"]) for r in own.collect()]))

    if not sizes:
        left = _windows(docs.limit(0), "doc_id", "text", size)
    elif wanted is not None and blocks == 1:  # what is left of a document is little, and both searches are made in one reading
        left = stored(_windows(docs, "doc_id", "text", size, wanted, sizes, block(0)), "windows")
    else:
        left = stored(_windows(docs, "doc_id", "text", size, wanted, sizes).join(items.select("h", "size").distinct(), ["h", "size"], "left_semi"), "windows")
    stands = [left] if wanted is not None and blocks == 1 else [_windows(docs, "doc_id", "text", size, None, (), block(k)) for k in range(blocks)]
    pairs = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("of"), b.alias("to")))
    item = ["id", "text_key", "item_id", "item_key", "n_words"]
    match = F.struct("item_pos", F.col("item_words").alias("words"), "pos", pairs.alias("pairs"))
    stride = F.greatest("n_words", F.lit(16).cast("long"))
    # A phrase of many items says little: rare windows propose an item for a document, and of the others only those of proposed pairs are joined.
    own = left.where("size > 0").select("id", "text_key", "size", "pos", "h", "slots")
    rare = own.join(right.where("rare"), ["h", "size"]).select(*item, match.alias("m"), "pos")
    pair = ["id", "text_key", "item_id", "item_key"]
    proposed = rare.select(*[F.col(c).alias(f"p_{c}") for c in pair]).distinct()
    others = right.where("NOT rare")
    others = others.join(proposed, others["item_id"].eqNullSafe(F.col("p_item_id")) & (others["item_key"] == F.col("p_item_key"))).withColumnsRenamed({"h": "p_h", "size": "p_size"})
    common = own.join(others, own["id"].eqNullSafe(F.col("p_id")) & (own["text_key"] == F.col("p_text_key")) & (own["h"] == F.col("p_h")) & (own["size"] == F.col("p_size")))
    met = rare.union(common.select(*item, match.alias("m"), "pos")).select(*item, "m", F.floor(F.col("pos") / stride).alias("at"))
    stretches = met.select(*item, "m", F.explode(F.sequence(F.col("at") - 2, F.col("at"))).alias("stretch")).groupBy(*item, "stretch").agg(F.collect_set("m").alias("matches"))
    spec = "doc_id long, item_id long, n_windows long, n_matched long, coverage double"

    def judge(batches):
        for b in batches:
            out = []
            for doc_id, item_id, n, low, step, matches in zip(*(b.column(c).to_pylist() for c in ("id", "item_id", "n_words", "low", "step", "matches")), strict=True):
                own = [(m["item_pos"], m["words"], m["pos"], tuple((p["of"], p["to"]) for p in m["pairs"])) for m in matches]
                coverage, longest, n_met = judged(own, n, low, low + step)
                if coverage >= share or longest >= run:
                    out.append((doc_id, item_id, n - min(size, n) + 1, n_met, coverage))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["doc_id", "item_id", "n_windows", "n_matched", "coverage"])

    best = stretches.select("id", "item_id", "n_words", ((F.col("stretch") + 1) * stride).alias("low"), stride.alias("step"), "matches").mapInArrow(judge, spec)
    n_windows = (F.col("n") - F.least(F.lit(size), F.col("n")) + 1).alias("n_windows")
    for found in stands:
        own = found.where("size = 0").select(F.col("id").alias("doc_id"), F.col("slots")[0].cast("long").alias("item_id"), n_windows, "n")
        best = best.union(own.select("doc_id", "item_id", "n_windows", F.col("n_windows").alias("n_matched"), F.lit(1.0).alias("coverage")))
    return best.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "n_windows", "n_matched")).alias("b")).select("doc_id", "item_id", "b.n_windows", "b.n_matched", "b.coverage")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that hold a benchmark item, other rows as they are, repeated ones too. A row goes if its doc_id, or null, does; null and empty
    texts hold nothing. No rows, no result."""
    gone = contaminated(docs, benchmark).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]), "left_anti").select(docs.columns)
