"""Benchmark decontamination: templates with typed slots, joined by the hashes of their windows."""

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import rows_of

# Words, numbers, and the marks after which a capital does not make a name.
TOKENS = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?:\n]").findall

# Words and signs that count as units of measure.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds ounce "
    "ounces ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years dollar dollars euro euros cent cents percent degree degrees meter meters metre metres "
    "kilometer kilometers kilometre kilometres mph kmh watt watts volt volts".split()
)

LITERAL, NUMBER, NAME, UNIT, MARK = range(5)

# Tokens a task remembers; beyond, it starts afresh. No result depends on it.
REMEMBERED = 300_000
MIX = np.uint64(0x9E3779B97F4A7C15)
FILTER = np.uint64((1 << 20) - 1)
TEXTS = 64  # Gone through at a time.


class _Tokens(dict):
    """Per token the hash of its lower case, and in the last three bits its kind where nothing opens before it."""

    def __missing__(self, token: str) -> int:
        low = token.lower()
        if token in ".!?:\n":
            kind = MARK
        elif token[0].isdigit():
            kind = NUMBER
        elif low in UNITS:
            kind = UNIT
        else:
            kind = NAME if len(token) > 1 and token[0].isupper() else LITERAL
        self[token] = value = xxhash.xxh64_intdigest(low) & ~7 | kind
        return value


class Canonical:
    """Templates of texts, one after the other: per token its kind, value, code, and how many tokens are left in its text.

    Numbers, units and names become placeholders. A name is a capitalised word of two letters or more
    that does not open the text, a line or a sentence. Case and punctuation do not count otherwise.
    `plain` has a name's code as a word: what a window's first token counts as whatever stands before it.
    """

    def __init__(self, texts: list[str], known: dict):
        if len(known) > REMEMBERED:
            known.clear()
        found = [TOKENS(t or "") for t in texts]
        packed = np.fromiter((known[t] for tokens in found for t in tokens), np.uint64, sum(map(len, found)))
        text = np.repeat(np.arange(len(found)), [len(tokens) for tokens in found])
        kinds = (packed & np.uint64(7)).astype(np.int8)
        opens = np.ones(len(kinds), bool)
        opens[1:] = (kinds[:-1] == MARK) | (text[1:] != text[:-1])
        kinds[opens & (kinds == NAME)] = LITERAL
        words = kinds != MARK
        self.text, self.kinds, self.values = text[words], kinds[words], packed[words] & ~np.uint64(7)
        word = self.values | np.uint64(4)
        self.codes = np.where(self.kinds == LITERAL, word, self.kinds.astype(np.uint64))
        self.plain = np.where(self.kinds == NAME, word, self.codes)
        self.sizes = np.bincount(self.text, minlength=len(found))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.left = (self.starts + self.sizes)[self.text] - np.arange(len(self.text))

    def windows(self, widths: list[int]):
        """(width, family, starts, hashes) of all windows. Families: exact ones, templates, and templates that
        begin with a name, its word in place of it."""
        for family, first, codes in (("exact", self.values, self.values), ("template", self.codes, self.codes), ("template", self.plain, self.codes)):
            out = np.zeros(len(codes), np.uint64)
            for j in range(max(widths, default=0)):
                size = len(codes) - j
                if size <= 0:
                    break
                out = out[:size] * MIX + (first if j == 0 else codes[j:])
                out ^= out >> np.uint64(29)
                if j + 1 in widths:
                    whole = self.left[:size] > j
                    if first is self.plain:
                        whole &= self.kinds[:size] == NAME
                    at = np.flatnonzero(whole)
                    yield j + 1, family, at, out[at]


def consistent(kinds: np.ndarray, ours: np.ndarray, theirs: np.ndarray) -> bool:
    """Whether equal slots of one text are equal in the other, per kind and in both directions."""
    there, back = {}, {}
    for kind, a, b in zip(kinds.tolist(), ours.tolist(), theirs.tolist(), strict=True):
        if kind != LITERAL and (there.setdefault((kind, a), b) != b or back.setdefault((kind, b), a) != a):
            return False
    return True


class Templates:
    """Windows of benchmark items by hash, exact and as templates; small enough to be sent to every task."""

    def __init__(self, items: list[tuple[int, str]], width: int, least_literals: int):
        self.ids = [item_id for item_id, _ in items]
        self.items = Canonical([text for _, text in items], _Tokens())
        own = np.minimum(width, self.items.sizes)
        self.widths = sorted(set(own[own > 0].tolist()))
        literal = np.concatenate([[0], np.cumsum(self.items.kinds == LITERAL)])
        found = defaultdict(list)
        for n, family, at, hashes in self.items.windows(self.widths):
            asked = own[self.items.text[at]] == n
            if family == "template":
                # A name that counts as a word is one more.
                named = (self.items.kinds[at] == NAME) if (n, family) in found else 0
                asked &= literal[at + n] - literal[at] + named >= least_literals
            found[n, family].append((hashes[asked], at[asked]))
        self.tables, self.filters = {}, {}
        for key, parts in found.items():
            hashes, at = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            if len(hashes):
                order = np.argsort(hashes, kind="stable")
                self.tables[key] = hashes[order], at[order]
                self.filters[key] = np.zeros(int(FILTER) + 1, bool)
                self.filters[key][hashes & FILTER] = True

    def matches(self, texts: list[str], known: dict) -> dict[tuple[int, int], set]:
        """Per (text, item) its windows (text start, item start, width, whether all slots are the same), if consistent."""
        given, items, out = Canonical(texts, known), self.items, defaultdict(set)
        for n, family, at, hashes in given.windows(self.widths):
            if (n, family) not in self.tables:
                continue
            maybe = self.filters[n, family][hashes & FILTER]
            at, hashes = at[maybe], hashes[maybe]
            table, places = self.tables[n, family]
            low, high = (np.searchsorted(table, hashes, side) for side in ("left", "right"))
            for start, a, b in zip(at.tolist(), low.tolist(), high.tolist(), strict=True):
                mine = slice(start, start + n)
                for place in places[a:b].tolist():
                    other = slice(place, place + n)
                    same = np.array_equal(given.values[mine], items.values[other])
                    if not same and (family == "exact" or not self._alike(given, mine, other)):
                        continue
                    text, item = int(given.text[start]), int(items.text[place])
                    out[text, item].add((start - int(given.starts[text]), place - int(items.starts[item]), n, same))
        return out

    def _alike(self, given: Canonical, mine: slice, other: slice) -> bool:
        items, first, place = self.items, mine.start, other.start
        kinds = items.kinds[other].copy()
        if given.codes[first] != items.codes[place]:
            if given.plain[first] != items.plain[place]:
                return False
            kinds[0] = NAME  # The same word, a name in one of them.
        rest = slice(first + 1, mine.stop), slice(place + 1, other.stop)
        return np.array_equal(given.codes[rest[0]], items.codes[rest[1]]) and consistent(
            kinds, items.values[other], given.values[mine]
        )


def _find(templates: Templates):
    names = ["doc_id", "item_id", "n_windows", "first_word", "end_word", "exact"]
    kinds = [pa.int64()] * 5 + [pa.bool_()]

    def run(batches):
        known = _Tokens()
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, TEXTS):
                ids, texts = zip(*rows_of([batch.slice(at, TEXTS)], "doc_id", "text"), strict=True)
                for (text, item), windows in templates.matches(texts, known).items():
                    starts, _, widths, same = zip(*windows, strict=True)
                    end = max(map(sum, zip(starts, widths, strict=True)))
                    out.append((ids[text], templates.ids[item], len(windows), min(starts), end, all(same)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)

    return run


def _blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The benchmark in parts of about `block_bytes` of text: a query set that is sent to all rows."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // block_bytes) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    return [benchmark.where(part == i) for i in range(parts)]


def leaks(
    documents: DataFrame, benchmark: DataFrame, width: int = 13, least_literals: int = 5, block_bytes: int = 16 << 20
) -> DataFrame:
    """(doc_id, item_id, n_windows, first_word, end_word, exact): which documents hold benchmark items.

    Takes (doc_id, text) and (item_id, text). A document holds an item if a window of `width` tokens
    (the whole item, if shorter) has the same words and numbers, case and punctuation aside. It also
    does if such a window has the same template and its slots are consistent: equal numbers,
    names or units stand for equal ones, in both directions. So a question whose numbers or names were
    changed is found, one with the roles mixed up is not. exact: all slots are the same, too.
    Templates with fewer than `least_literals` plain words are only looked for as they are. A window's
    first word is compared as a word, and as a name where both texts have one there. NULL and empty texts hold
    nothing; repeated rows give repeated rows. A benchmark beyond `block_bytes` is gone through in
    blocks of that size, one scan each; words are counted from 0, ends are exclusive.
    """
    schema = "doc_id long, item_id long, n_windows long, first_word long, end_word long, exact boolean"
    texts = documents.select("doc_id", "text")
    found = None
    for block in _blocks(benchmark.select("item_id", "text").where("text IS NOT NULL"), block_bytes):
        items = [(r["item_id"], r["text"]) for r in block.collect()]
        part = texts.mapInArrow(_find(Templates(items, width, least_literals)), schema)
        found = part if found is None else found.unionByName(part)
    return found


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`documents` without those that hold a benchmark item; columns and all other rows stay as they are."""
    texts = [i for i, c in enumerate(documents.columns) if c == "text"][0]
    schema = documents.schema
    kept = documents
    for block in _blocks(benchmark.select("item_id", "text").where("text IS NOT NULL"), options.pop("block_bytes", 16 << 20)):
        templates = Templates(
            [(r["item_id"], r["text"]) for r in block.collect()], options.get("width", 13), options.get("least_literals", 5)
        )

        def clean(batches, templates=templates):
            known = _Tokens()
            for batch in batches:
                for at in range(0, batch.num_rows, TEXTS):
                    some = batch.slice(at, TEXTS)
                    held = {text for text, _ in templates.matches(some.column(texts).to_pylist(), known)}
                    yield some.filter(pa.array([i not in held for i in range(some.num_rows)], pa.bool_()))

        kept = kept.mapInArrow(clean, schema)
    return kept
