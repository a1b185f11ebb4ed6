"""Phrase collocations: candidates counted by double-array tries, Apriori level by level.

1. Blocks: a task turns texts of one lang into blocks of at most ``BLOCK`` words: numbers of the
   block's own vocabulary (16 bits where it allows), 0 where a piece ends. All later passes read these, in numpy.
2. Words: the counts of their hashes are summed over the corpus as in 3; words whose hash reaches ``min_count``
   are named, and their own counts summed. Those with ``min_count`` are level 1.
3. Candidates of k words: a position counts only if both its phrases of k-1 words are frequent, told by
   a bitmap of fixed size (``BITS``; a false hit only adds candidates). The hashes of its k words are
   summed over the corpus: no less than the phrase's count, so every phrase whose hash stays below
   ``min_count`` is safely out. A task sums the hashes of several blocks and packs them by their first bits: a row is a bucket
   with the next 32 bits of its hashes and their counts, five bytes each; ``_buckets`` takes so many that a bucket's
   hashes fit a task whatever the corpus. The hashes left, again as a bitmap, tell the blocks which phrases to name. With its
   count a hash carries the number (two bytes, of the block's own content) of one block that holds it, and only blocks
   of that number name its phrases: each is named about once, not once for every task that meets it.
4. Tries: candidates are dealt by hash to shards of about ``SHARD`` phrases at most, and a task builds each
   shard's double array: a word is three byte steps, a state's next is ``base[state] + byte``, valid if its
   ``check`` is the state. A shard's trie is broadcast (its size is bounded by ``SHARD``, whatever the
   corpus); numpy advances the states of a block's positions (those whose hash is the shard's and a candidate's)
   together, byte by byte, word by word, and counts accepting states with ``bincount``. Sums over tasks give the counts of level k.
   A position whose hash is in the shard but whose phrase isn't (two phrases of one hash, the other one was named) is
   counted by its phrase, so equal hashes lose nothing.
5. Scores: every cut of a candidate joins the counts of its two parts; the lowest score stays, decimals keep
   it exact. Candidates that lie mostly inside a longer one go, then each lang's first are ranked.

Defined cases: null text is empty, null lang is ``und``; a piece without words has no phrases; words keep all
characters but blanks, tabs and separators; equal scores go to the larger count, then to the
smaller phrase in UTF-8 order; repeated rows count each; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, python_ready, written

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2_000
INSIDE_PERCENT = 50
BLOCK = 250_000
SHARD = 300_000
BITS = 26
HELD = 1 << 19
BUCKET = 1 << 19
SCALE = 1_000_000
DIGITS = 3
NO_LANG = "und"
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(10 if b in _SEPARATORS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_SLICE = 4 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)  # any odd number
_BLOCKS = "lang string, n_words long, ids binary, ends binary, words binary"  # a block's words are one value: Spark copies it whole


def _width(words: int) -> str:
    return "<u2" if words < 1 << 16 else "<i4"


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) - 1
        return n


class _Open:
    """A block that still takes texts."""

    def __init__(self):
        self.numbers, self.parts, self.size = _Numbers({b"\n": 0, b"": -1}), [], 0

    def add(self, text: bytes) -> None:
        text, at = text.translate(_BYTES).replace(b"\n", b" \n ") + b" \n", 0
        while at < len(text):
            end = text.find(b" ", at + _SLICE)
            tokens = (text[at:end] if end >= 0 else text[at:]).split(b" ")
            at = end + 1 if end >= 0 else len(text)
            ids = np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens))
            ids = ids[ids >= 0]
            self.parts.append(ids)
            self.size += len(ids)

    def row(self, lang: str) -> pa.RecordBatch:
        ids = np.concatenate(self.parts)
        names = [w for w, n in self.numbers.items() if n > 0]
        ends = np.cumsum(np.fromiter(map(len, names), np.int32, len(names)), dtype="<i4")
        binary = (pa.array([x], pa.binary()) for x in (ids.astype(_width(len(names))).tobytes(), ends.tobytes(), b"".join(names)))
        return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([int((ids > 0).sum())]), *binary], ["lang", "n_words", "ids", "ends", "words"])


def _to_blocks(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Open] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                block = held.setdefault(lang, _Open())
                block.add(text.as_py())
                if block.size >= limit:
                    yield held.pop(lang).row(lang)
                elif sum(x.size for x in held.values()) >= 4 * limit:
                    largest = max(held, key=lambda x: held[x].size)
                    yield held.pop(largest).row(largest)
        for lang, block in held.items():
            yield block.row(lang)

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, pa.Array]]:
    """(lang, ids, words from number 1 on; number 0 is a piece's end) of each block."""
    for b in batches:
        for lang, ids, ends, words in zip(b.column("lang").to_pylist(), *(b.column(c) for c in ("ids", "ends", "words")), strict=True):
            offsets = np.append(np.int32(0), np.frombuffer(ends.as_buffer(), "<i4"))
            names = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), words.as_buffer()])
            yield lang, np.frombuffer(ids.as_buffer(), _width(len(names))).astype(np.int32, copy=False), names


def _word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit polynomials over the bytes of each word (none is empty)."""
    if not len(words):
        return np.empty(0, np.uint64)
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[at[0]:at[-1]]
    at -= at[0]
    lens = np.diff(at)
    powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(int(lens.max()), _STEP))])
    h = np.add.reduceat((data + np.uint64(1)) * powers[np.arange(len(data)) - np.repeat(at[:-1], lens)], at[:-1])
    return (h ^ (h >> np.uint64(32))) * _STEP


def _seeds(langs: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(x.encode()) for x in langs], np.uint64) * _STEP


def _hashes(lang: str, words: pa.Array) -> np.ndarray:
    """By word number; number 0 is no word."""
    h = np.concatenate([np.zeros(1, np.uint64), _word_hashes(words) ^ _seeds([lang])])
    return h ^ (h >> np.uint64(31))


def _extended(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of its words but the last, and that of the last."""
    return (h ^ (h >> np.uint64(29))) * _STEP + word


def _place(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h * _STEP) >> np.uint64(64 - bits)).astype(np.int64)


def _has(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    at = _place(h, bits)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) != 0


def _grams(ids: np.ndarray, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k words from each position, and whether these lie in one piece."""
    out, ok, m = h[ids], ids > 0, len(ids)
    for j in range(1, k):
        out, ok = _extended(out[:m - j], h[ids[j:]]), ok[:m - j] & (ids[j:] > 0)
    return out, ok


def _hopeful(lang: str, ids: np.ndarray, words: pa.Array, k: int, frequent: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of k words whose first and last k-1 words are both frequent, and the hashes there."""
    h = _hashes(lang, words)
    if len(ids) < k:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    part, whole = _grams(ids, h, k - 1)
    part_ok = whole.copy()
    at = np.flatnonzero(whole)
    part_ok[at] = _has(frequent, part[at], bits)
    gram, ok = _grams(ids, h, k)
    at = np.flatnonzero(ok & part_ok[:len(ok)] & part_ok[1:len(ok) + 1])
    return at, gram[at]


def _number(ids: np.ndarray) -> np.uint16:
    """A block's number: two bytes that follow from its content, the same in every pass."""
    return np.uint16(zlib.crc32(np.ascontiguousarray(ids, np.int32)) & 0xFFFF)


def _held_by(codes: np.ndarray, holder: np.ndarray) -> np.ndarray:
    """The hash of a phrase's code with the number of a block."""
    return _extended(codes.astype(np.uint64), np.atleast_1d(holder).astype(np.uint64) * _STEP)


def _codes(h: np.ndarray, first: int) -> np.ndarray:
    """The bits of hashes that are summed: ``first`` for the bucket and 32 more."""
    return _place(h, first + 32)


def _summed(codes: np.ndarray, n: np.ndarray, holder: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes, the sum of their counts, and one of their holders (by a turn that follows from the code)."""
    if not len(codes):
        return codes, n, holder
    order = np.argsort(codes)
    codes = codes[order]
    new = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    turn = (codes & 0xFFFF).astype(np.uint16)
    return codes[new], np.add.reduceat(n[order], new), np.minimum.reduceat(holder[order] ^ turn, new) ^ turn[new]


def _hash_counts(k: int, frequent, bits: int, first: int, min_count: int):
    """(bucket, low, n, holder): the hashes of a bucket, their counts, cut to ``min_count`` and to a byte: enough to be kept, and
    of each the number of a block that holds it."""
    most = min(min_count, 255)

    def packed(held: list) -> pa.RecordBatch:
        codes, n, holder = _summed(*map(np.concatenate, zip(*held, strict=True)))
        at = np.flatnonzero(np.append(True, codes[1:] >> 32 != codes[:-1] >> 32)) if len(codes) else np.empty(0, np.int64)
        ends = np.append(at, len(codes)).astype(np.int32)
        low, n8 = (codes & 0xFFFFFFFF).astype("<u4"), np.minimum(n, most).astype(np.uint8)

        def lists(values: np.ndarray) -> pa.Array:
            offsets = (ends * values.itemsize).astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])

        return pa.RecordBatch.from_arrays([pa.array((codes[at] >> 32).astype(np.int32)), lists(low), lists(n8), lists(holder.astype("<u2"))],
                                          ["bucket", "low", "n", "holder"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for lang, ids, words in _rows(batches):
            if k == 1:
                n = np.bincount(ids, minlength=len(words) + 1)[1:].astype(np.int64)
                held.append((_codes(_hashes(lang, words)[1:], first), n, np.zeros(len(n), np.uint16)))  # words have no holders
            else:
                codes, n = np.unique(_codes(_hopeful(lang, ids, words, k, frequent.value, bits)[1], first), return_counts=True)
                held.append((codes, n, np.full(len(codes), _number(ids))))
            size += len(held[-1][0])
            if size >= HELD:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    return run


def _kept(min_count: int):
    enough = min(min_count, 255)  # above a byte this only keeps more candidates

    def run(key: tuple, table: pa.Table) -> pa.Table:
        """The hashes of one bucket that reach ``min_count``, and a holder of each."""
        low, n, holder = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(c)] or [np.empty(0, kind)])
                          for c, kind in (("low", "<u4"), ("n", np.uint8), ("holder", "<u2")))
        codes, n, holder = _summed(low, n.astype(np.int64), holder)
        kept = n >= enough
        return pa.table({"h": pa.array((np.int64(key[0].as_py()) << 32) + codes[kept].astype(np.int64)), "holder": pa.array(holder[kept].astype(np.int32))})

    return run


def _buckets(n_words: int) -> int:
    """Bits of the bucket: about ``BUCKET`` hashes each at most, were no two positions' equal."""
    return min(30, max(8, (n_words // BUCKET).bit_length()))


def _unique_at(ids: np.ndarray, at: np.ndarray, k: int, n: int) -> np.ndarray:
    """One of the positions of every distinct phrase of k word numbers up to n."""
    wide = n.bit_length()
    if k * wide > 63:
        return np.unique(np.column_stack([ids[at + j] for j in range(k)]), axis=0, return_index=True)[1]
    packed = np.zeros(len(at), np.int64)
    for j in range(k):
        packed = packed << wide | ids[at + j]
    return np.unique(packed, return_index=True)[1]


def _named(k: int, frequent, hopeful, bits: int, first: int, holders=None):
    """(lang, phrase, h) of phrases whose hash may be frequent, once for several blocks; with ``holders`` by the hash's own blocks."""
    names = ["lang", "phrase", "h"]

    def merged(held: list) -> list:
        return pa.Table.from_batches(held).group_by(names).aggregate([]).select(names).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for lang, ids, words in _rows(batches):
            at, gram = _hopeful(lang, ids, words, k, frequent.value, bits)
            some = _has(hopeful.value, gram, bits)
            at, gram = at[some], gram[some]
            if holders is not None:
                own = _has(holders.value, _held_by(_codes(gram, first), _number(ids)), bits)
                at, gram = at[own], gram[own]
            # phrases of a block by their word numbers: equal hashes of two phrases keep both
            one = _unique_at(ids, at, k, len(words))
            at, gram = at[one], gram[one]
            columns = [words.take(pa.array(ids[at + j] - 1)).cast(pa.binary()) for j in range(k)]
            phrases = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary())).cast(pa.string())
            held.append(pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), phrases, pa.array(_codes(gram, first))], names))
            size += len(at)
            if size >= HELD:
                held = merged(held)
                size = sum(b.num_rows for b in held)
                if size >= HELD // 2:
                    yield from held
                    held, size = [], 0
        if held:
            yield from merged(held)

    return run


def _word_counts(hopeful, bits: int):
    """(lang, phrase, n) of words whose hash may be frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ids, words in _rows(batches):
            at = np.flatnonzero(_has(hopeful.value, _hashes(lang, words)[1:], bits))
            n = np.bincount(ids, minlength=len(words) + 1)[1:].astype(np.int64)[at]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), words.take(pa.array(at)).cast(pa.string()), pa.array(n)],
                                             ["lang", "phrase", "n"])

    return run


def double_array(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """base and check of the trie over sorted, distinct rows of bytes; row i ends in a state with base -1 - i.

    States are placed together, those with many children first: each tries a random base, and
    those whose children's slots are free and their own get them.
    """
    n, depth = keys.shape
    fresh = np.ones((depth, n), bool)
    for d in range(depth):
        fresh[d, 1:] = (keys[1:, d] != keys[:-1, d]) | (fresh[d - 1, 1:] if d else False)
    level = [np.cumsum(f) - 1 for f in fresh]  # the node of each row, per depth
    firsts = [np.flatnonzero(f) for f in fresh]
    start = np.concatenate([[1], 1 + np.cumsum([len(f) for f in firsts])])  # node 0 is the root
    symbol = np.concatenate([np.zeros(1, np.int64), *[keys[f, d].astype(np.int64) for d, f in enumerate(firsts)]])
    parent = np.concatenate([np.zeros(1, np.int64), *[(start[d - 1] + level[d - 1][f] if d else np.zeros(len(f), np.int64)) for d, f in enumerate(firsts)]])
    nodes = len(symbol)
    children = np.bincount(parent[1:], minlength=nodes)
    first_child = np.searchsorted(parent[1:], np.arange(nodes), "left") + 1  # nodes go level by level: children lie together
    rng, size = np.random.default_rng(0), 2 * nodes + 1024
    taken = np.zeros(size + 256, bool)
    taken[0] = True  # the root's own slot
    base = np.zeros(nodes, np.int64)
    owner = np.empty(size + 256, np.int64)
    for least in (128, 64, 32, 16, 8, 4, 2, 1):
        todo = np.flatnonzero((children >= least) & (children < (2 * least if least < 128 else 1 << 30)))
        tries = 0
        while len(todo):
            tries += 1
            if tries % 40 == 0:  # crowded: twice the room
                taken, owner, size = np.concatenate([taken, np.zeros(size, bool)]), np.empty(2 * size + 256, np.int64), 2 * size
            at = rng.integers(1, size, len(todo))
            c = children[todo]
            who = np.repeat(np.arange(len(todo)), c)
            child = np.arange(c.sum()) + np.repeat(first_child[todo] - np.cumsum(c) + c, c)
            slots = at[who] + symbol[child]
            owner[slots] = who
            good = np.logical_and.reduceat(~taken[slots] & (owner[slots] == who), np.cumsum(c) - c)
            base[todo[good]] = at[good]
            taken[slots[good[who]]] = True
            todo = todo[~good]
    slot = np.zeros(nodes, np.int64)
    slot[1:] = base[parent[1:]] + symbol[1:]
    size = int(slot.max()) + 257
    to, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    to[slot] = base
    check[slot[1:]] = slot[parent[1:]]
    last = start[depth - 1] + level[depth - 1] if n else np.empty(0, np.int64)
    to[slot[last]] = -1 - np.arange(n)
    return to, check


def _digits(words: np.ndarray) -> np.ndarray:
    """Bytes of word numbers, word by word: (rows, words) to (rows, words * DIGITS)."""
    return np.concatenate([(words[:, j:j + 1] >> (8 * (DIGITS - 1 - d)) & 255) for j in range(words.shape[1]) for d in range(DIGITS)], axis=1).astype(np.uint8)


def _build(k: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """The trie of one shard: a row per phrase, and one with the arrays and each lang's words, numbered from 1 on."""
        table = table.combine_chunks()
        lang, phrase = table.column("lang").combine_chunks(), table.column("phrase").combine_chunks()
        n, upto = len(table), 1
        words = pc.split_pattern(phrase, " ").flatten()
        ids = np.empty((n, k), np.int64)
        langs, names = pc.unique(lang).to_pylist(), []
        for one in langs:
            rows = np.flatnonzero(pc.equal(lang, one).to_numpy(zero_copy_only=False))
            own = words.take(pa.array((rows[:, None] * k + np.arange(k)).ravel())).dictionary_encode()
            ids[rows] = own.indices.to_numpy().reshape(-1, k) + upto
            names.append(own.dictionary.cast(pa.binary()).to_pylist())
            upto += len(own.dictionary)
        keys = _digits(ids)
        order = np.lexsort(keys.T[::-1])
        base, check = double_array(keys[order])
        none, order = [None] * n, pa.array(order)
        return pa.table({
            "shard": pa.array([key[0].as_py()] * (n + 1), pa.int32()), "idx": pa.array([*range(n), None], pa.int32()),
            "lang": pa.concat_arrays([lang.take(order), pa.nulls(1, lang.type)]), "phrase": pa.concat_arrays([phrase.take(order), pa.nulls(1, phrase.type)]),
            "base": pa.array([*none, base.tobytes()], pa.binary()), "check": pa.array([*none, check.tobytes()], pa.binary()),
            "langs": pa.array([*none, langs], pa.list_(pa.string())), "words": pa.array([*none, names], pa.list_(pa.list_(pa.binary()))),
            "codes": pa.array([*none, np.unique(table.column("h").to_numpy()).astype("<i8").tobytes()], pa.binary())})

    return run


_TRIE = "shard int, idx int, lang string, phrase string, base binary, `check` binary, langs array<string>, words array<array<binary>>, codes binary"
_COUNTS = "shard int, idx int, n long, stray struct<lang: string, phrase: string>"  # stray: a phrase that has no idx


def _advanced(base: np.ndarray, check: np.ndarray, at: np.ndarray, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States one word further, byte by byte; positions whose state has no such next drop out."""
    for d in range(DIGITS):
        to = base[state] + (word >> (8 * (DIGITS - 1 - d)) & 255)
        valid = check[to] == state
        at, state, word = at[valid], to[valid], word[valid]
    return at, state


def _count(k: int, trie, shard: int, shards: int, hopeful, bits: int, first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, check, first_number, names, *more = trie.value
        codes = np.frombuffer(more[0], "<i8") if more else np.empty(0, np.int64)  # of the shard's phrases
        strays: Counter = Counter()
        base, check = np.frombuffer(base, np.int32), np.frombuffer(check, np.int32)
        n, size = int(-base.min()), 1 + sum(map(len, names.values()))
        counts, numbers = np.zeros(n, np.int64), {}
        after = np.full(size, -1, np.int32)  # the state that each word leads to from the root: the first level of all positions
        first_words, to = _advanced(base, check, np.arange(size), np.zeros(size, np.int32), np.arange(size, dtype=np.int32))
        after[first_words] = to
        for lang, ids, words in _rows(batches):
            if lang not in names or len(ids) < k:
                continue
            if lang not in numbers:
                held = names[lang].to_pylist()
                numbers[lang] = dict(zip(held, range(first_number[lang], first_number[lang] + len(held)), strict=True))
            gram, ok = _grams(ids, _hashes(lang, words), k)
            at = np.flatnonzero(ok)
            at = at[_codes(gram[at], first) % shards == shard]
            at = at[_has(hopeful.value, gram[at], bits)]  # all positions of the shard's phrases, and few others
            every = at
            used = np.zeros(len(words) + 1, bool)
            for j in range(k):
                used[ids[at + j]] = True
            used = np.flatnonzero(used)
            own = np.zeros(len(words) + 1, np.int32)
            own[used] = [numbers[lang].get(w, 0) for w in words.take(pa.array(used - 1)).to_pylist()]
            at = at[own[ids[at]] > 0]
            state = after[own[ids[at]]]
            at, state = at[state >= 0], state[state >= 0]
            for j in range(1, k):
                word = own[ids[at + j]]
                at, state = _advanced(base, check, at[word > 0], state[word > 0], word[word > 0])
            counts += np.bincount(-1 - base[state], minlength=n)
            if len(codes):  # positions of the shard's hashes but of none of its phrases
                other = np.setdiff1d(every, at, assume_unique=True)
                own = _codes(gram[other], first)
                other = other[codes[np.minimum(np.searchsorted(codes, own), len(codes) - 1)] == own]
                for i in other.tolist():
                    strays[lang, b" ".join(words.take(pa.array(ids[i:i + k] - 1)).to_pylist()).decode()] += 1
        some = np.flatnonzero(counts)
        rest = len(strays)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(some) + rest, shard, np.int32)), pa.array([*some.tolist(), *[None] * rest], pa.int32()),
             pa.array(np.append(counts[some], np.fromiter(strays.values(), np.int64, rest))),
             pa.array([*[None] * len(some), *[{"lang": x, "phrase": p} for x, p in strays]], pa.struct([("lang", pa.string()), ("phrase", pa.string())]))],
            ["shard", "idx", "n", "stray"])

    return run


def _bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """2**bits bits, set at the values of ``at``: packed by word in Spark, at most 2**(bits - 6) rows here."""
    packed = places.groupBy(F.expr("at div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[packed.column("w").to_numpy()] = packed.column("b").to_numpy()
    return out.astype("<i8").view(np.uint8)


def _phrase_places(k: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = pc.split_pattern(b.column(1), " ").flatten()
            h = _word_hashes(words).reshape(-1, k) ^ _seeds(b.column(0).to_pylist())[:, None]
            h ^= h >> np.uint64(31)
            out = h[:, 0]
            for j in range(1, k):
                out = _extended(out, h[:, j])
            yield pa.RecordBatch.from_arrays([pa.array(_place(out, bits))], ["at"])

    return run


def _holder_places(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_place(_held_by(b.column(0).to_numpy(), b.column(1).to_numpy()), bits))], ["at"])

    return run


def _hash_places(bits: int, first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(b.column(0).to_numpy() >> (first + 32 - bits))], ["at"])

    return run


def _hashes_kept(blocks: DataFrame, k: int, frequent, min_count: int, bits: int, first: int) -> tuple[DataFrame, object]:
    """The hashes of k words with at least ``min_count`` positions (and a holder), and a broadcast bitmap of them."""
    sums = blocks.mapInArrow(_hash_counts(k, frequent, bits, first, min_count), "bucket int, low binary, n binary, holder binary")
    hashes = written(sums.groupBy("bucket").applyInArrow(_kept(min_count), "h long, holder int"), "hashes")
    places = hashes.select("h").mapInArrow(_hash_places(bits, first), "at long")
    return hashes, blocks.sparkSession.sparkContext.broadcast(_bitmap(places, bits))  # 2**bits bits


def _words(blocks: DataFrame, min_count: int, bits: int, first: int) -> DataFrame:
    """Words with their counts: lang, phrase, n (at least ``min_count``)."""
    hopeful = _hashes_kept(blocks, 1, None, min_count, bits, first)[1]
    words = blocks.mapInArrow(_word_counts(hopeful, bits), "lang string, phrase string, n long")
    return written(words.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "words")


def _level(blocks: DataFrame, shorter: DataFrame, k: int, min_count: int, shard_size: int, bits: int, first: int) -> DataFrame:
    """Phrases of k words with their counts: lang, phrase, n (at least ``min_count``)."""
    spark = blocks.sparkSession
    sc = spark.sparkContext
    frequent = sc.broadcast(_bitmap(shorter.select("lang", "phrase").mapInArrow(_phrase_places(k - 1, bits), "at long"), bits))  # 2**bits bits
    hashes, hopeful = _hashes_kept(blocks, k, frequent, min_count, bits, first)
    holders = sc.broadcast(_bitmap(hashes.select("h", "holder").mapInArrow(_holder_places(bits), "at long"), bits))  # 2**bits bits
    named = blocks.mapInArrow(_named(k, frequent, hopeful, bits, first, holders), "lang string, phrase string, h long").repartition("h").distinct()
    named = written(named.join(hashes, "h", "left_semi"), "named")
    shards = max(1, -(-named.count() // shard_size))
    dealt = named.withColumn("shard", (F.col("h") % shards).cast("int"))
    tries = written(dealt.groupBy("shard").applyInArrow(_build(k), _TRIE), "tries")
    parts = None
    for shard in range(shards):
        got = tries.filter((F.col("shard") == shard) & F.col("base").isNotNull()).select("base", "check", "langs", "words", "codes").toArrow()
        if not got.num_rows:
            continue
        langs, words = got.column("langs")[0].as_py(), got.column("words")[0].values
        numbers = np.cumsum([1, *[len(w) for w in words]]).tolist()
        trie = sc.broadcast((got.column("base")[0].as_py(), got.column("check")[0].as_py(), dict(zip(langs, numbers, strict=False)),
                             {x: pa.array(words[i].as_py(), pa.binary()) for i, x in enumerate(langs)},
                             got.column("codes")[0].as_py()))  # about shard_size phrases
        part = blocks.mapInArrow(_count(k, trie, shard, shards, hopeful, bits, first), _COUNTS)
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return spark.createDataFrame([], "lang string, phrase string, n long")
    counts = written(parts.groupBy("shard", "idx", "stray").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "counts")
    phrases = tries.filter("idx IS NOT NULL").select("shard", "idx", "lang", "phrase")
    found = counts.join(phrases, ["shard", "idx"]).select("lang", "phrase", "n")
    return written(found.unionByName(counts.filter("idx IS NULL").select("stray.lang", "stray.phrase", "n")), "level")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, text_col: str = "text", lang_col: str = "lang",
                  block: int = BLOCK, shard_size: int = SHARD, bits: int = BITS) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases by length (lang, phrase, n; first the words), and n (all words) per lang."""
    python_ready(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    blocks = written(texts.mapInArrow(_to_blocks(block), _BLOCKS), "blocks")
    first = _buckets(blocks.agg(F.sum("n_words")).first()[0] or 0)
    coded = blocks.select("lang", "ids", "ends", "words")
    levels = [_words(coded, min_count, bits, first)]
    for k in range(2, max_words + 1):
        levels.append(_level(coded, levels[-1], k, min_count, shard_size, bits, first))
    return levels, blocks.groupBy("lang").agg(F.sum("n_words").alias("n_all"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, inside_percent: int = INSIDE_PERCENT,
                 **how) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each lang. ``how``: see ``phrase_counts``."""
    levels, totals = phrase_counts(docs, min_count, max_words, **how)
    known = levels[0]
    for level in levels[1:]:
        known = known.unionByName(level)
    phrases = levels[1] if len(levels) > 1 else levels[0].limit(0)
    for level in levels[2:]:
        phrases = phrases.unionByName(level)
    phrases = phrases.withColumnRenamed("n", "a").withColumn("words", F.split("phrase", " "))

    size = F.size("words")
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
                     F.array_join(F.slice("words", F.col("k") + 1, size), " ").alias("right"))
    cut = cut.join(known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cut = cut.join(known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    a, left, right = (F.col(c).cast("decimal(15,0)") for c in "alr")
    cut = cut.withColumn("score", _div(F.lit(SCALE).cast("decimal(7,0)") * (a * a), left * right).cast("long"))
    best = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    inner = F.expr("flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), "
                   "i -> array_join(slice(words, i, m), ' '))))")
    longer = phrases.filter(size > 2).select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    own = best.join(longer, ["lang", "phrase"], "left")
    own = own.filter(F.coalesce(100 * F.col("longer") < inside_percent * F.col("a"), F.lit(True)))
    own = own.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    own = own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return own.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                           F.col("n_all").alias("n"), "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir, "text", "lang"))


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
piece AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
numbered AS (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM piece),
word AS (SELECT lang, p, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM numbered),
w AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM word WINDOW o AS (PARTITION BY p ORDER BY i)),
g AS (SELECT lang, 1 AS m, w1 AS phrase FROM w
      UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM w WHERE w2 IS NOT NULL
      UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM w WHERE w3 IS NOT NULL),
f AS (SELECT lang, m, phrase, count(*)::HUGEINT AS n FROM g GROUP BY ALL),
total AS (SELECT lang, sum(n) AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND n >= 10),
cut AS (SELECT *, unnest(range(1, m)) AS k FROM cand),
sides AS (SELECT lang, m, phrase, a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:], ' ') AS rp FROM cut),
part AS (SELECT s.*, fl.n AS l, fr.n AS r, (1000000 * a * a) // (fl.n * fr.n) AS score FROM sides s
         JOIN f fl ON fl.lang = s.lang AND fl.phrase = s.lp JOIN f fr ON fr.lang = s.lang AND fr.phrase = s.rp),
best AS (SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, phrase, max(a) AS longer FROM (
             SELECT lang, a, ws[1] || ' ' || ws[2] AS phrase FROM cand WHERE m = 3
             UNION ALL SELECT lang, a, ws[2] || ' ' || ws[3] FROM cand WHERE m = 3) GROUP BY ALL),
left_over AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, total.n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
