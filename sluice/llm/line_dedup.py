"""Operator 8: line dedup by a zone-partition edit join.

Lines that are equal (by 128 bits of SHA-256) are links, and so are lines of ``EDITED`` code points or
more within ``THRESHOLD`` edits of each other, and lines within one changed, added
or missing word for every ``WORDS`` words of the one with fewer; a class is what
links reach.  The first line of a class, by (document id, line number), stays and
the others go.

Join.  Lines are dealt into ranges of sizes, and one a little longer than a range
belongs to it too.  The lines of a range have one zone more than edits that may
part them, the first half counted from their start, the others from their end.  Of
two linked lines some zone is untouched and has as many edits before it as zones, so
that what it holds has moved by no more than that, and from the other end likewise.  A line is keyed by (range,
zone, piece) for the piece at the zone's place and for those that start up to so
much further in: of two lines that moved apart, one has its first piece where the other has a later one.  Lines of 20 to
40 words have zones of code points and, for one edit, of words; longer ones of words alone, two words apart.
Of two lines of ``LONG`` words the shorter one has ``GRAM + WINDOW - 1`` words in a row that the other one holds too:
both are keyed by the gram of least hash in every window of grams, with the
line's size and the gram's place as overlapping ranges (winnowing), so that a
line has keys in proportion to its length, whatever its threshold.
Keys are hashes: rows are two numbers, whatever the line's length, and
a line that repeats inside a task is keyed once.  Sorted by key, the rows of
keys that two lines or more share pass in one streaming scan.  Only those lines
get their texts (found again through a Bloom filter of fixed size), meet in
blocks of bounded size, and are verified by banded bit-parallel edit distance,
pairs whose counts of code points or words alone tell them apart left out.
Blocks return a spanning forest of the verified links and not all pairs.

Defined cases: lines are cut at ``\\n``; blank lines (empty, or white space only)
are left alone; a word is a run of anything but white space, and a code point from
U+0E00 on (scripts without spaces) is a word of its own; a null text stays null
and has no lines; a text of which every line goes becomes empty; null ids come last in the order; rows equal in id and text count
as one document, and each of them keeps the same lines; documents with one id
are ordered by a hash of their text; an empty table gives an empty result;
columns that clash with a result's name are replaced by the result, those with an
inner name (``_INNER``) are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from operator import ne

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable, mix, others, powers, slices, stored
from .graph import components

THRESHOLD = 2
LEAST = 1                   # code points of the shortest line looked at
EDITED = 16                 # shorter lines link where they are equal only
WORDS = 20                  # words of a line for each word that may differ
LONG = 140                  # lines of so many words are keyed by winnowed grams
GRAM, WINDOW = 5, 13        # one of every 17 words in a row: lines of LONG words or more share as many
STEP = 6                    # of ranges of sizes: so many elements, or this part of the least size
BLOCK = 256                 # lines of one key compared in one row
SEEN = 1 << 21              # line hashes a task remembers as already keyed
BINS = 32                   # of a line's counts of code points, and of words
MEMBERS = 1 << 15           # lines compared together
FIRST_KEYS = 16             # of a line's shared keys go with it
FEW = 128                   # lines of one key up to which all their pairs are met at once
BLOOM_BITS = 1 << 24
_SLICE = 1 << 20
_WIDE = 0x0E00
#: Of the code points up to the last blank one, and of all others: 0 blank, 1 part of a word, 2 a word.
_KIND = np.array([0 if chr(i).isspace() else 1 + (i >= _WIDE) for i in range(0x3002)], np.uint8)
DIGEST = 16                 # bytes of SHA-256 by which lines are held to be equal
_WORD = re.compile("[^\\s\\u0e00-\\U0010ffff]+|[^\\s\\u0000-\\u0dff]")
#: Sizes at which the ranges of long lines begin; each is wider than the words by which two lines may differ.
_EDGES = np.array([LONG << j for j in range(30)], np.int64)
SPAN = 12                   # ranges of a gram's place are so many times as wide as it may move


def _mixed(cp: np.ndarray) -> np.ndarray:
    x = (cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_MIXED = _mixed(np.arange(1 << 16))          # of the code points that most texts are made of


class Lines:
    """The lines of a run of texts as code points: range, 63-bit hash, substring hashes."""

    def __init__(self, values: list[str | None]):
        text = "\n".join(v or "" for v in values)
        self.cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        cut = np.flatnonzero(self.cp == 10)
        self.start = np.append(0, cut + 1)
        self.end = np.append(cut, len(self.cp))
        up, self.down = powers(len(self.cp) + 1)
        self.total = np.zeros(len(self.cp) + 1, np.uint64)
        x = self.total[1:]
        _MIXED.take(self.cp, out=x, mode="clip")
        far = np.flatnonzero(self.cp >= len(_MIXED))
        x[far] = _mixed(self.cp[far])
        x *= up[:-1]
        np.cumsum(x, out=x)
        self.hash = self.piece(self.start, self.end) >> np.uint64(1)

    def sums(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal for equal pieces, but not yet mixed."""
        return (self.total[end] - self.total[start]) * self.down[start]

    def piece(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.sums(start, end) + (end - start).astype(np.uint64))


def written(values: list[str | None], least: int) -> tuple[list[int], list[int], list[int], list[str]]:
    """Of the lines of ``least`` code points or more that are not blank: the text's number, the line's
    number in it and among the lines of all ``values``, and the line."""
    of, number, rows, said, at = [], [], [], [], 0
    for i, value in enumerate(values):
        lines = value.split("\n") if value else ()
        for n, line in enumerate(lines):
            if len(line) >= least and not line.isspace():
                of.append(i)
                number.append(n)
                rows.append(at + n)
                said.append(line)
        at += len(lines) or 1
    return of, number, rows, said


def digests(lines: list[str]) -> list[bytes]:
    return [hashlib.sha256(line.encode()).digest()[:DIGEST] for line in lines]


def hashes(exact: list[bytes]) -> np.ndarray:
    """63 bits of every digest."""
    return np.frombuffer(b"".join(exact), "<u8").reshape(-1, DIGEST // 8)[:, 0] >> np.uint64(1)


def _inside(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the range, and place, of every element of some ranges."""
    size = end - start
    of = np.repeat(np.arange(len(size)), size)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + start[of]


def _slack(edits: int) -> list[int]:
    """Of every zone, by how much ``edits`` spots of edits move what it holds, if it is the one they must leave."""
    return [min(i, edits - i) for i in range(edits + 1)]


def zone_keys(lines: Lines, rows: np.ndarray, least: np.ndarray, slack: list[int], gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``(key, value)`` of the pieces of ``rows``; a value is a line's hash with a last bit set for all but first pieces.

    A line of ``least`` elements or more has a zone for every entry of ``slack``, ``gap`` elements apart, the first
    half at places counted from its start, the others from its end.  A zone is as long as a piece and its
    slack, and keyed by the pieces at its place and up to slack further in: of two lines that hold a
    zone alike and moved by its slack or less, one has its first piece among the other's.
    """
    half, edits = (len(slack) - 1) // 2, len(slack) - 1
    size = (least - sum(slack) - gap * edits) // (edits + 1)
    some, size = size > 0, np.maximum(size, 0)                # too short for zones: all such lines share a key
    start, end, own = lines.start[rows], lines.end[rows], lines.hash[rows] << np.uint64(1)
    key, value = [], []
    for i in range(edits + 1):
        before = slack[:i] if i <= half else slack[i + 1:]
        place = len(before) * (size + gap) + sum(before)
        salt = (least * 1024 + i + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for more in range(slack[i] + 1):
            first = np.where(some, start + place + more if i <= half else end - place - more - size, start)
            key.append(mix(lines.sums(first, first + size) + salt))
            value.append(own | np.uint64(more > 0))
    return np.concatenate(key), np.concatenate(value)


def keys(lines: Lines, rows: np.ndarray, threshold: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """``(key, value)`` by which lines of ``least`` elements or more within ``threshold`` edits share a key, one of
    them under a first piece.  Every range of sizes has zones of its own, and lines up to ``threshold`` longer have them too."""
    size = lines.end[rows] - lines.start[rows]
    edges, longest = [least], int(size.max(initial=0))
    while edges[-1] <= longest:
        edges.append(edges[-1] + max(STEP, edges[-1] // STEP))
    edges = np.array(edges)
    low = np.searchsorted(edges, np.maximum(size - threshold, least), side="right") - 1
    of, at = _inside(low, np.where(size < least, low, np.searchsorted(edges, size, side="right")))
    return zone_keys(lines, rows[of], edges[at], _slack(threshold))


class InWords(Lines):
    """The same lines as sequences of words: ``start`` and ``end`` count words."""

    def __init__(self, lines: Lines):
        kind = _KIND.take(lines.cp, mode="clip")
        first, narrow = kind > 0, kind == 1
        last = first.copy()
        apart = ~(narrow[1:] & narrow[:-1])
        first[1:] &= apart
        last[:-1] &= apart
        begin, self.hash = np.flatnonzero(first), lines.hash
        self.word = word = lines.piece(begin, np.flatnonzero(last) + 1)
        self.start, self.end = np.searchsorted(begin, lines.start), np.searchsorted(begin, lines.end)
        up, self.down = powers(len(word) + 1)
        self.total = np.zeros(len(word) + 1, np.uint64)
        np.cumsum(word * up[:-1], out=self.total[1:])


def _over(x: np.ndarray, least: bool) -> np.ndarray:
    """Least or greatest of every ``WINDOW`` values in a row."""
    step, of = 1, np.minimum if least else np.maximum
    while 2 * step <= WINDOW:
        x = of(x[:-step], x[step:])
        step *= 2
    rest = WINDOW - step
    return of(x[:-rest], x[rest:]) if rest else x


def winnowed(words: InWords, rows: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """``(key, value)`` of the grams that stand for the long lines ``rows``."""
    count, none = len(words.total) - 1, np.zeros(0, np.uint64)
    n = count - GRAM - WINDOW + 2                             # windows of grams
    if n <= 0 or not len(rows):
        return none, none
    p = np.arange(count - GRAM + 1)
    gram = words.piece(p, p + GRAM)
    taken = np.zeros(len(words.start), bool)
    taken[rows] = True
    of = np.searchsorted(words.start, p, side="right") - 1
    inside = taken[of[:n]] & (p[:n] + GRAM + WINDOW - 1 <= words.end[of[:n]])
    lowest = np.where(inside, _over(gram, True), np.uint64(0))
    pad = np.zeros(WINDOW - 1, np.uint64)
    at = np.flatnonzero((_over(np.concatenate([pad, lowest, pad]), False) == gram) & (gram > 0))
    line, place = of[at], at - words.start[of[at]]
    size = words.end[line] - words.start[line]
    key, value = [], []
    own = np.searchsorted(_EDGES, size, side="right") - 1
    for up in (0, 1):
        k = np.arange(len(at)) if not up else np.flatnonzero(size + np.maximum(2 * threshold, size // WORDS) >= _EDGES[own + 1])
        j = own[k] + up
        shift = np.maximum(2 * threshold, (_EDGES[j + 1] - 1) // WORDS)
        low, high = place[k] // (SPAN * shift), (place[k] + shift) // (SPAN * shift)
        for part, span in ((slice(None), low), (np.flatnonzero(high > low), high)):
            salt = (j[part] * 1_000_003 + span[part] + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            key.append(mix(gram[at[k[part]]] + salt))
            value.append(words.hash[line[k[part]]] << np.uint64(1))
    key, value = np.concatenate(key), np.concatenate(value)
    order = np.lexsort((value, key))                          # a line that repeats itself has its grams once
    key, value = key[order], value[order]
    fresh = np.append(True, (key[1:] != key[:-1]) | (value[1:] != value[:-1]))[:len(key)]
    return key[fresh], value[fresh]


def all_keys(lines: Lines, rows: np.ndarray, threshold: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """``(key, value)`` by which any two linked lines among ``rows`` share a key.

    Lines of fewer than ``LONG`` words have zones of words, with slack for the words that may differ.  An edit
    of a code point touches three adjacent words at most (a wide one and both beside it), hence not two
    zones two words apart, and moves the words behind it by two at most; two edits either leave the first or the
    last zone, or all others, of which one has that slack.  More edits, and shorter lines, take zones of code points.
    """
    words = InWords(lines)
    size = words.end[rows] - words.start[rows]
    run = GRAM + WINDOW - 1
    letters = 2 * WORDS if threshold <= 2 else max(LONG, 3 * threshold + (run - 1) * (threshold + 1) + 1)
    found = [keys(lines, rows[size < letters + 2 * threshold], threshold, least),
             keys(words, rows[(size >= WORDS) & (size <= 2 * WORDS)], 1, WORDS),
             winnowed(words, rows[size >= LONG], threshold)]
    for differ in range(2, LONG // WORDS):
        slack, low = _slack(differ), differ * WORDS
        if max(slack) < 2:
            slack[1] = 2
        k = rows[(size >= low) & (size < low + WORDS + max(2 * min(threshold, 2), differ))]
        found.append(zone_keys(words, k, np.full(len(k), low), slack, 2))
    key, value = (np.concatenate(x) for x in zip(*found))
    return key, value


def _trim(a: Sequence, b: Sequence) -> tuple[Sequence, Sequence]:
    """Both without what they share at the beginning and at the end."""
    def shared(match) -> int:
        low, high = 0, min(len(a), len(b))
        while low < high:
            middle = (low + high + 1) // 2
            if match(middle):
                low = middle
            else:
                high = middle - 1
        return low

    n = shared(lambda k: a[:k] == b[:k])
    a, b = a[n:], b[n:]
    n = shared(lambda k: a[len(a) - k:] == b[len(b) - k:])
    return a[:len(a) - n], b[:len(b) - n]


def within(a: Sequence, b: Sequence, threshold: int) -> bool:
    """Whether the edit distance is at most ``threshold``: bit vectors over a diagonal band."""
    if abs(len(a) - len(b)) > threshold:
        return False
    a, b = _trim(a, b)
    if len(a) > len(b):
        a, b = b, a
    m, n, k = len(a), len(b), threshold
    if n <= k:
        return True
    if m <= k:                                                # fewer rows than the band: the plain table
        row = list(range(m + 1))
        for j, c in enumerate(b, 1):
            row, last = [j], row
            for i in range(1, m + 1):
                row.append(min(row[i - 1] + 1, last[i] + 1, last[i - 1] + (a[i - 1] != c)))
        return row[m] <= k
    # Bit t of column j stands for row j - k + t; vertical steps are +1 from row 0 down at first.
    width = 2 * k + 1
    full = (1 << width) - 1
    plus, minus, distance = (full >> k) << k, 0, k
    where: dict = {}                                          # rows that hold each value, as far as the band has come
    for i in range(k):
        where[a[i]] = where.get(a[i], 0) | 1 << i
    for j in range(n):
        if j + k < m:
            where[a[j + k]] = where.get(a[j + k], 0) | 1 << (j + k)
        rows = where.get(b[j], 0)
        same = (rows >> (j - k) if j >= k else rows << (k - j)) & full
        diagonal = ((((same & plus) + plus) ^ plus) | same | minus) & full
        across_plus = (minus | ~(diagonal | plus)) & full
        across_minus = diagonal & plus
        if j < m - k:                                         # along the band's lowest diagonal
            distance += not diagonal >> (width - 1) & 1
            if distance > k + (n - m + k):
                return False
        else:                                                 # then along the last row
            bit = m - 1 - j + k
            distance += (across_plus >> bit & 1) - (across_minus >> bit & 1)
        below = diagonal >> 1
        plus = (across_minus | ~(below | across_plus)) & full
        minus = below & across_plus
    return distance <= k


def sketches(lines: Lines, words: InWords, rows: np.ndarray) -> np.ndarray:
    """How often each line holds the code points and the words of each of ``BINS`` bins, 255 at most, as bytes.

    An edit changes the counts of code points, and one of words those of words, by
    two at most; bins and the cap only lower a difference.
    """
    parts = []
    for where, value in ((lines, lines.cp.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), (words, words.word)):
        of, at = _inside(where.start[rows], where.end[rows])
        bins = (value[at] >> np.uint64(40)).astype(np.int64) % BINS
        parts.append(np.bincount(of * BINS + bins, minlength=len(rows) * BINS).reshape(-1, BINS))
    return np.minimum(np.concatenate(parts, axis=1), 255).astype(np.uint8)


def verified(a: str, b: str, by_letter: bool, by_word: bool, threshold: int) -> bool:
    """Whether two lines are linked, as far as what their sketches leave open."""
    if by_word:
        x, y = _WORD.findall(a), _WORD.findall(b)
        most = min(len(x), len(y)) // WORDS
        # A word changed, added or missing adds to what only one of them holds by two words at most.
        if len({*x} ^ {*y}) <= 2 * most and (len(x) == len(y) and sum(map(ne, x, y)) <= most or within(x, y, most)):
            return True
    return by_letter and within(a, b, threshold)


class Block:
    """Lines that share keys: sizes in code points and words, and sketches."""

    def __init__(self, letters: np.ndarray, words: np.ndarray, sketch: np.ndarray, threshold: int):
        self.letters, self.words, self.sketch, self.threshold = letters, words, sketch, threshold

    def near(self, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of lines: which may be within the threshold, and which within the words that may differ."""
        allowed = np.minimum(self.words[u], self.words[v]) // WORDS
        by_letter = np.abs(self.letters[u] - self.letters[v]) <= self.threshold
        by_word = (allowed > 0) & (np.abs(self.words[u] - self.words[v]) <= allowed)
        for some, part, most in ((by_letter, slice(0, BINS), np.full(len(u), self.threshold)), (by_word, slice(BINS, None), allowed)):
            k = np.flatnonzero(some)
            for at in range(0, len(k), 1 << 14):
                j = k[at:at + (1 << 14)]
                differ = np.abs(self.sketch[u[j], part].astype(np.int16) - self.sketch[v[j], part]).sum(axis=1)
                some[j] = differ <= 2 * most[j]
        return by_letter, by_word


def _pairs(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs inside each of some ranges."""
    of, at = _inside(begin, end)
    u, k = _inside(at + 1, end[of])
    return at[u], k


def block_forest(block: Block, begin: np.ndarray, end: np.ndarray, text, smaller: list[frozenset]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the verified links inside each range of lines.

    ``smaller``: keys of each line before the one that its range shares.  A pair that
    shares one of these too is left to it: it is compared under its first key only.
    Pairs are met a bounded number at a time; what is already connected is not compared.
    """
    up = list(range(len(smaller)))
    edges = []

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def compare(u: np.ndarray, v: np.ndarray) -> None:
        by_letter, by_word = block.near(u, v)
        near = np.flatnonzero(by_letter | by_word)
        last, said = None, ""                     # pairs come in the order of their first lines
        for x, y, letter, word in zip(*(z[near].tolist() for z in (u, v, by_letter, by_word))):
            if not smaller[x].isdisjoint(smaller[y]):
                continue
            a, b = find(x), find(y)
            if a == b:
                continue
            if x != last:
                last, said = x, text(x)
            if verified(said, text(y), letter, word, block.threshold):
                up[max(a, b)] = min(a, b)
                edges.append((x, y))

    size = end - begin
    large = size > FEW
    # Small ranges together, as many as make about a million pairs; a large one line by line.
    small = np.flatnonzero(~large)
    if len(small):
        part = np.cumsum(size[small] ** 2) // (1 << 21)
        for k in np.split(small, np.flatnonzero(np.diff(part)) + 1):
            compare(*_pairs(begin[k], end[k]))
    for r in np.flatnonzero(large).tolist():
        left, stop = np.arange(begin[r], end[r]), 0
        while len(left):                          # breadth first, so that what a line links to goes at once
            queue, left = [int(left[0])], left[1:]
            while queue and len(left):
                u, known = queue.pop(), len(edges)
                compare(np.full(len(left), u), left)
                linked = {y for _, y in edges[known:]}
                queue += linked
                left = left[[v not in linked for v in left.tolist()]] if linked else left
    return edges


def forest(lines: list[str], threshold: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among a few lines (without line ends inside)."""
    found = Lines(lines)
    words, rows = InWords(found), np.arange(len(lines))
    block = Block(found.end - found.start, words.end - words.start, sketches(found, words, rows), threshold)
    return block_forest(block, np.array([0]), np.array([len(lines)]), lines.__getitem__, [frozenset()] * len(lines))


def linked_lines(batch: pa.RecordBatch, threshold: int) -> pa.RecordBatch:
    """``(a, b)``: verified links inside each row's ``members``, those of which the row's key ``k`` is the first they share."""
    column = batch.column("members")
    start = column.offsets.to_numpy().astype(np.int64)
    start -= start[0]
    line, said, sketch, letters, words, ks = column.flatten().flatten()[:6]
    n = len(line)
    bounds = ks.offsets.to_numpy().astype(np.int64)
    of, at = _inside(bounds[:-1], bounds[1:])
    values = ks.values.to_numpy()[at]
    less = values < np.repeat(batch.column("k").to_numpy(), np.diff(start))[of]
    stop = np.append(0, np.cumsum(np.bincount(of[less], minlength=n))).tolist()
    values = values[less].tolist()
    smaller = [frozenset(values[i:j]) for i, j in zip(stop, stop[1:])]
    places, data = sketch.buffers()[1:]
    at = np.frombuffer(places, np.int32, n + 1, 4 * sketch.offset)
    rows = np.frombuffer(data, np.uint8, 2 * BINS * n, int(at[0])).reshape(n, 2 * BINS)
    block = Block(letters.to_numpy(), words.to_numpy(), rows, threshold)
    edges = block_forest(block, start[:-1], start[1:], lambda i: said[i].as_py(), smaller)
    u, v = np.array(edges, np.int64).reshape(-1, 2).T
    ids = line.to_numpy()
    return pa.RecordBatch.from_arrays([pa.array(ids[u]), pa.array(ids[v])], names=["a", "b"])


def _signatures(docs: DataFrame, text: str, threshold: int, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                values = part.column(text).to_pylist()
                _, _, rows, said = written(values, least)
                own, first = np.unique(hashes(digests(said)), return_index=True)
                new = ~np.isin(own, seen, assume_unique=True)
                rows = np.array(rows, np.int64)[first[new]]
                if not len(rows):
                    continue
                lines = Lines(values)
                lines.hash[rows] = own[new]
                seen = np.concatenate([seen if len(seen) < SEEN else seen[:0], lines.hash[rows]])
                key, value = all_keys(lines, rows, threshold, least)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(value.view(np.int64))], names=["k", "v"])

    return docs.select(text).mapInArrow(run, "k long, v long")


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``rows``, none empty."""
    held, count = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            count += batch.num_rows
        if count >= rows:
            yield pa.concat_batches(held)
            held, count = [], 0
    if held:
        yield pa.concat_batches(held)


def _shared(signatures: DataFrame) -> DataFrame:
    """``(k, line)`` of keys held by two lines or more, by one of them for a first piece; a row may come again.

    Rows come sorted by key, and pass batch by batch.  The last key of
    a batch may go on in the next: its rows are held until a second line and a
    first piece have shown that it is shared, and from then on pass at once.
    Keys that end inside a batch are renamed by the lines they hold, so that many
    keys shared by the same lines become one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_v = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        shared_key = last_line = None                     # the key passing at once, its last line

        for batch in gathered(batches):
            k = np.concatenate([held_k, batch.column(0).to_numpy()])
            v = np.concatenate([held_v, batch.column(1).to_numpy().view(np.uint64)])
            # Most keys come once, and go at once if they neither go on from the last batch nor may go on in the next.
            starts = np.append(True, k[1:] != k[:-1])
            some = ~(starts & np.append(starts[1:], False))
            some[0] |= shared_key is not None and k[0] == shared_key
            k, v = k[some], v[some]
            order = np.lexsort((v, k))          # Spark sorts by the key alone, which its radix sort can do
            k, v = k[order], v[order]
            line = v >> np.uint64(1)
            begin = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            size = np.diff(np.append(begin, len(k)))
            index = np.maximum.reduceat((v & np.uint64(1)) == 0, begin)
            several = np.maximum.reduceat(line, begin) != np.minimum.reduceat(line, begin)
            shared = index & several
            going_on = shared_key is not None and k[0] == shared_key
            shared[0] |= going_on
            fresh = np.append(not going_on or line[0] != last_line, (k[1:] != k[:-1]) | (line[1:] != line[:-1]))
            keep = np.repeat(shared, size) & fresh
            whole = np.append(np.ones(len(begin) - 1, bool), False)
            whole[0] &= not going_on
            held = np.add.reduceat(np.where(keep, mix(line), np.uint64(0)), begin)
            name = np.repeat(np.where(whole, mix(held).view(np.int64), k[begin]), size)
            yield pa.RecordBatch.from_arrays([pa.array(name[keep]), pa.array(line[keep].astype(np.int64))], names=["k", "line"])
            if shared[-1]:
                shared_key, last_line, held_k, held_v = k[-1], line[-1], k[:0], v[:0]
            else:
                shared_key = None
                held_v = np.unique(v[begin[-1]:])
                held_k = np.full(len(held_v), k[-1])

    parts = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (signatures.repartition(parts, "k").sortWithinPartitions("k")
            .mapInArrow(run, "k long, line long"))


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = mix(h.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    mask = np.uint64(BLOOM_BITS - 1)
    return (x & mask).astype(np.int64), ((x >> np.uint64(32)) & mask).astype(np.int64)


def _bloom(lines: DataFrame) -> np.ndarray:
    """A Bloom filter of ``BLOOM_BITS`` over ``lines(line)``.  False positives only cost time."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(BLOOM_BITS, bool)
        for batch in batches:
            for b in _bits(batch.column(0).to_numpy()):
                flags[b] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(flags).tobytes()], pa.binary())], names=["b"])

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(BLOOM_BITS // 8, np.uint8)
        for batch in batches:
            for b in batch.column(0):
                flags |= np.frombuffer(b.as_buffer(), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([flags.tobytes()], pa.binary())], names=["b"])

    rows = lines.coalesce(16).mapInArrow(bits, "b binary").repartition(1).mapInArrow(union, "b binary").collect()
    return np.frombuffer(bytes(rows[0][0]), np.uint8)


def _in_bloom(packed: np.ndarray, h: np.ndarray) -> np.ndarray:
    one, two = _bits(h)
    set_ = [(packed[b >> 3] >> (7 - (b & 7)).astype(np.uint8)) & 1 for b in (one, two)]
    return (set_[0] & set_[1]) != 0


_FETCHED = [T.StructField("line", T.LongType()), T.StructField("t", T.StringType()), T.StructField("sketch", T.BinaryType()),
            T.StructField("letters", T.LongType()), T.StructField("words", T.LongType())]


def _lines(docs: DataFrame, id_col: str, text: str, wanted: DataFrame, least: int, edited: int) -> tuple[DataFrame, DataFrame]:
    """``(id, _key, line_no, exact)`` of every line of ``least`` code points or more that is not blank, and
    ``(line, t, sketch, letters, words)`` of every line hash in ``wanted``: a text with it, its sketch and sizes.

    One pass over the texts, stored; a Bloom filter tells which lines may be wanted.
    """
    rows = docs.select(id_col, F.xxhash64(id_col, text).alias("_key"), text)
    own = [rows.schema[id_col], T.StructField("_key", T.LongType()), T.StructField("line_no", T.IntegerType()),
           T.StructField("exact", T.BinaryType())]
    schema = T.StructType([*own, *_FETCHED])
    sent = docs.sparkSession.sparkContext.broadcast(_bloom(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, text, _SLICE):
                of, number, _, said = written(part.column(text).to_pylist(), least)
                exact = digests(said)
                take, n = pa.array(of, pa.int32()), len(of)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(number, pa.int32()), pa.array(exact, pa.binary()),
                     pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()),
                     pa.nulls(n, pa.int64())], names=schema.names)
                own = hashes(exact)
                met = [r for r in np.flatnonzero(_in_bloom(sent.value, own)).tolist()
                       if len(said[r]) >= edited and (h := int(own[r])) not in seen and not seen.add(h)]
                if len(seen) > SEEN // 8:
                    seen = set()
                if not met:
                    continue
                said = [said[r] for r in met]
                few, n = Lines(said), len(said)           # only these, as words too
                words = InWords(few)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, part.column(0).type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                     pa.array(own[met].astype(np.int64)), pa.array(said, pa.string()),
                     pa.array([x.tobytes() for x in sketches(few, words, np.arange(n))], pa.binary()),
                     pa.array(few.end - few.start), pa.array(words.end - words.start)], names=schema.names)

    done = stored(rows.mapInArrow(run, schema), "lines")
    sent.destroy()
    fetched = done.where("t IS NOT NULL").select(*[f.name for f in _FETCHED])
    fields = F.struct(*[f.name for f in _FETCHED[1:]])
    texts_ = (fetched.join(wanted, "line", "left_semi").groupBy("line").agg(F.min(fields).alias("_")).select("line", "_.*"))
    return done.where("t IS NULL").select(*[f.name for f in own]), stored(texts_, "line-texts")


def line_classes(shared: DataFrame, found: DataFrame, threshold: int) -> DataFrame:
    """``(exact, component)``: digest of every line that links to others unlike it, and its class.

    Candidates are kept by a 63-bit hash; of unlike lines with one hash the least
    text stands for it, and ``exact`` tells which that is.  Keys are dealt into
    blocks before the lines' texts join them, so that texts are shuffled once.
    """
    sizes = shared.groupBy("k").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    c = F.ceil(F.col("_n") / F.lit(BLOCK)).cast("int")
    dealt = (shared.join(sizes, "k")
             .select("k", "line", F.pmod(F.xxhash64("line"), c).cast("int").alias("_c"), F.explode(F.sequence(F.lit(0), c - 1)).alias("_j"))
             .select("k", "line", F.least("_c", "_j").alias("_i"), F.greatest("_c", "_j").alias("_j")))
    first = shared.groupBy("line").agg(F.slice(F.array_sort(F.collect_list("k")), 1, FIRST_KEYS).alias("ks"))
    value = F.struct("line", "t", "sketch", "letters", "words", "ks")
    blocks = (dealt.join(found.join(first, "line"), "line").repartition("k", "_i", "_j")
              .groupBy("k", "_i", "_j").agg(F.collect_list(value).alias("members")).select("k", "members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stops = np.cumsum(np.diff(batch.column("members").offsets.to_numpy()), dtype=np.int64)
            at = 0
            while at < len(stops):                    # rows of about MEMBERS lines together
                before = stops[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(stops, before + MEMBERS, side="right")))
                yield linked_lines(batch.slice(at, to - at), threshold)
                at = to

    linked = components(blocks.mapInArrow(run, "a long, b long"))
    exact = F.unhex(F.substring(F.sha2("t", 256), 1, 2 * DIGEST)).alias("exact")
    return linked.join(found.select(F.col("line").alias("node"), exact), "node").select("exact", "component")


_RESULTS = ("n_lines", "removed", "n_removed")
_INNER = ("_key", "_gone", "_numbers", "_removed")
_REMOVED = "array<struct<line_no:int,first_doc_id:{0},first_line_no:int>>"


def dedupe_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: int = THRESHOLD,
                 least: int = LEAST) -> DataFrame:
    """``docs`` with lines that repeat an earlier one removed from ``text``, and what was removed.

    Adds ``n_lines`` (of the text as it was), ``n_removed`` and ``removed``: for
    every line that went, its number and the document and line that stay for it.
    """
    importable(docs.sparkSession)
    keep = others(docs, *_RESULTS, *_INNER)
    edited = max(least, EDITED)
    shared = stored(_shared(_signatures(docs, text, threshold, edited)).distinct(), "shared-keys")
    lines, found = _lines(docs, id_col, text, shared.select("line").distinct(), least, edited)
    classes = line_classes(shared, found, threshold)
    place = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("d"), "_key", F.col("line_no").alias("l"))
    # A class: a component, told by its least hash (8 bytes), or else one line, told by its digest (16).
    own = F.when(F.col("component").isNull(), F.col("exact")).otherwise(F.unhex(F.hex("component")))
    # Only lines met more than once, or linked to others, may lose one; the rest need no class and no rank.
    # Stored, so that each join is between two plain exchanges, which Spark can split where a class is hot.
    several = lines.groupBy("exact").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").select("exact")
    classes = stored(several.join(classes, "exact", "full_outer").select("exact", own.alias("_cls")), "line-classes")
    again = stored(lines.join(classes, "exact").select("_key", "line_no", "_cls", place.alias("_at")), "repeated-lines")
    first = stored(again.groupBy("_cls").agg(F.min("_at").alias("_first")), "first-lines")
    gone = (again.join(first, "_cls").where("_at != _first")
            .groupBy("_key").agg(F.collect_set(F.struct("line_no", F.col("_first.d").alias("first_doc_id"),
                                                        F.col("_first.l").alias("first_line_no"))).alias("_gone")))
    rows = docs.select(*keep).withColumn("_key", F.xxhash64(id_col, text)).join(gone.hint("shuffle_hash"), "_key", "left")
    removed = _REMOVED.format(docs.schema[id_col].dataType.simpleString())
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("n_lines", T.IntegerType()),
                           T.StructField("n_removed", T.IntegerType())])
    at = keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said, numbers = batch.column(text), batch.column("_numbers")
            less = pc.list_value_length(numbers)
            touched = pc.greater(less, 0)
            fresh = []
            for value, drop in zip(said.filter(touched).to_pylist(), numbers.filter(touched).to_pylist()):
                gone_ = set(drop)
                fresh.append("\n".join(x for n, x in enumerate(value.split("\n")) if n not in gone_))
            count = pc.fill_null(pc.add(pc.count_substring(said, "\n"), 1), 0)
            columns = [batch.column(c) for c in keep]
            columns[at] = pc.replace_with_mask(said, touched, pa.array(fresh, said.type))
            yield pa.RecordBatch.from_arrays([*columns, count.cast(pa.int32()), less.cast(pa.int32()), batch.column("_removed")],
                                             names=[*schema.names, "removed"])

    full = T.StructType([*schema.fields, T.StructField("removed", T._parse_datatype_string(removed))])
    return (rows.withColumn("_removed", F.coalesce(F.array_sort("_gone"), F.array().cast(removed)))
            .withColumn("_numbers", F.col("_removed.line_no")).drop("_gone", "_key").mapInArrow(run, full))
