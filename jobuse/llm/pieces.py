"""Byte-level BPE over Arrow batches, each distinct piece of text encoded once.

Byte-level BPE never merges across a single space that stands between two
non-space characters: the space opens the next pre-token. Texts are cut there
and the pieces of a slice made distinct; pieces met lately have their ids, and
the distinct pre-tokens of the others are encoded. Ids are gathered back with
array arithmetic.
"""

import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from jobuse.llm.words import LONG_WORD, string_hashes

SLICE_BYTES = 2 << 20       # text handled at a time

# Two white-space characters in a row, or one at the end, by the widest reading of white space.
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_DOUBLE_SPACE = _SPACE + "{2}"
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")

FindAll = Callable[[str], list[str]]        # the pre-tokens of a text


class Known:
    """Ids of the pieces met lately, as sorted arrays: two hashes of a piece lead to its run of ids."""

    LIMIT = 500_000         # pieces; then it starts anew

    def __init__(self, limit: int | None = None):
        self.limit = limit or self.LIMIT
        self.key = self.check = np.zeros(0, np.uint64)
        self.start = self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The place of each piece, or -1."""
        if not len(self.key):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (self.check[at] == check), at, -1)

    def add(self, key: np.ndarray, check: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        if len(self.key) + len(key) > self.limit:
            self.__init__(self.limit)
        order = np.argsort(key)
        start = len(self.ids) + np.cumsum(size) - size
        at = np.searchsorted(self.key, key[order])
        for name, new in (("key", key), ("check", check), ("start", start), ("size", size)):
            setattr(self, name, np.insert(getattr(self, name), at, new[order]))
        self.ids = np.concatenate([self.ids, ids])


def text_slices(texts: pa.Array, size: int = SLICE_BYTES):
    """Slices of a string array of about ``size`` bytes each (a long text stands alone)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(np.asarray(pc.binary_length(texts)))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
        yield texts.slice(at, to - at)
        at = to


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts, and how many each text has. Every text has one at least."""
    odd = pc.match_substring_regex(texts, _DOUBLE_SPACE)
    if pc.any(odd).as_py():
        lists = pa.array([_SAFE_CUT.split(t) if o else t.split(" ") for t, o in zip(texts.to_pylist(), odd.to_pylist())],
                         pa.large_list(pa.large_string()))
    else:
        lists = pc.split_pattern(texts, " ")
    counts = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    flat = pc.list_flatten(lists)
    first = np.zeros(len(flat), bool)
    first[np.cumsum(counts) - counts] = True
    space = pc.if_else(pa.array(first), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    return pc.binary_join_element_wise(space, flat, pa.scalar("", pa.large_string())), counts


def _runs(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ``flat``, one after another."""
    if not sizes.sum():
        return flat[:0]
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    at += np.arange(len(at))
    return flat[at]


def gathered(flat: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` (``lengths`` long) laid out in ``order``, one after another."""
    return _runs(flat, (np.cumsum(lengths) - lengths)[order], lengths[order])


def _joined(words: pa.Array) -> str:
    """All strings of a ``large_string`` array in one."""
    ends = np.frombuffer(words.buffers()[1], np.int64)
    return str(memoryview(words.buffers()[2])[ends[words.offset]: ends[words.offset + len(words)]], "utf-8") if len(words) else ""


def _pre_tokens(words: pa.Array, find_all: FindAll) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The pre-tokens of distinct pieces, how many each has, and the order that pieces are taken in.

    Pieces that open with a space and have none at the end can stand one after
    another without changing each other's pre-tokens; the rest are cut alone.
    """
    joins = np.asarray(pc.and_(pc.starts_with(words, " "), pc.invert(pc.match_substring_regex(words, f"{_DOUBLE_SPACE}|{_SPACE}$"))))
    joined = words.filter(pa.array(joins))
    tokens = find_all(_joined(joined))
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
    ends = np.searchsorted(ends, np.cumsum(pc.utf8_length(joined)), "left") + 1
    others = [find_all(w) for w in words.filter(pa.array(~joins)).to_pylist()]
    for x in others:
        tokens += x
    counts = np.concatenate([np.diff(ends, prepend=0), [len(x) for x in others]]).astype(np.int64)
    return tokens, counts, np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])


def _encode_pieces(words: pa.Array, coder) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct pieces, flat, and how many each has."""
    tokens, per_piece, order = _pre_tokens(words, coder.find_all)
    tokens = pc.dictionary_encode(pa.array(tokens, pa.large_string()))
    found = coder.encode_new(tokens.dictionary.to_pylist())
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ids = np.fromiter(chain.from_iterable(found), np.uint32, lengths.sum())
    kinds = np.asarray(tokens.indices)
    ends = np.concatenate([[0], np.cumsum(lengths[kinds])])[np.concatenate([[0], np.cumsum(per_piece)])]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return gathered(gathered(ids, lengths, kinds), np.diff(ends), place), np.diff(ends)[place]


def encode_slice(texts: pa.Array, coder) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts (unsigned 32-bit, flat), and how many each text has."""
    flat, counts = _pieces(texts)
    pieces = pc.dictionary_encode(flat)
    words, known = pieces.dictionary, coder.known
    key, check = string_hashes(words)
    short = np.asarray(pc.binary_length(words)) <= LONG_WORD
    at = np.where(short, known.find(key, check), -1)
    new = np.flatnonzero(at < 0)
    ids, sizes = _encode_pieces(words.take(pa.array(new)), coder)
    # The runs of all pieces: those known, then the new ones.
    starts, lengths = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
    hit = at >= 0
    starts[hit], lengths[hit] = known.start[at[hit]], known.size[at[hit]]
    starts[new], lengths[new] = len(known.ids) + np.cumsum(sizes) - sizes, sizes
    codes = np.asarray(pieces.indices)
    ends = np.cumsum(lengths[codes])[np.cumsum(counts) - 1] if len(counts) else np.zeros(0, np.int64)
    out = _runs(np.concatenate([known.ids, ids]), starts[codes], lengths[codes])
    keep = short[new]
    known.add(key[new][keep], check[new][keep], ids[np.repeat(keep, sizes)], sizes[keep])
    return out, np.diff(ends, prepend=0)


def encode_array(texts: pa.Array, coder) -> pa.Array:
    """Token ids of each text as ``list<int32>``; a null text has none.

    ``coder`` has ``find_all`` (the pre-tokens of a text), ``encode_new`` (the
    ids of distinct pre-tokens), ``known``, a ``Known``, and ``slice_bytes``.
    """
    parts = [encode_slice(t, coder) for t in text_slices(texts, coder.slice_bytes)]
    pa.default_memory_pool().release_unused()
    ids = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.uint32)])
    lengths = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)])
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))


def flat_lists(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list array (nulls: empty), and the length of each list."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
    return np.asarray(pc.list_flatten(lists)), lengths
