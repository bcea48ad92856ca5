"""Byte-level BPE: encoding to token ids with byte offsets, and decoding.

A text is cut into pre-tokens without a regular expression. Every code point
gets a class; with what follows it, the class becomes one of a few symbols, and
each symbol is a function on the states of a small automaton. Composition of
functions is associative, so the state in front of every character comes from
a blocked scan over whole arrays: blocks are composed on their own, the blocks'
functions are scanned in doubling steps, and a second pass marks the places
where a pre-token begins. The slices between them are merged pair by pair, and
a bounded cache keeps the ids of slices seen before.

The pre-tokens are those of the pattern of 50k byte-level vocabularies:
contractions (fixed: 's 't 're 've 'm 'll 'd), runs of letters, of numbers or of
other characters with at most one blank in front, and white space.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import add_columns, packed

MAX_CACHE = 100_000  # slices a Python worker remembers, and as many older ones
LONG_SLICE = 48  # bytes from which pairs are kept in a heap
BLOCK = 128  # characters of one row of the scan

# --- pre-tokenisation -------------------------------------------------------

LETTER, NUMBER, OTHER, SPACE = range(4)
# Symbols: a class, an apostrophe that begins a contraction of one or two
# letters, white space that a non-space follows, or any other white space.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_BLANK, S_LAST, S_SPACE = range(8)
# States: the last token is over; in letters, numbers, others, white space; a
# blank was taken as the front of the next token; one or two contraction
# letters are to come.
FRESH, IN_L, IN_N, IN_O, IN_S, FRONT, MORE1, MORE2 = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, is a beginning) by symbol * 8 + state; symbols from 8 on begin a text."""
    step = np.zeros((16, 8), np.uint8)
    begins = np.ones((16, 8), bool)

    def run_of(symbol: int, state: int) -> None:
        step[symbol] = state
        begins[symbol, [state, FRONT]] = False

    run_of(S_LETTER, IN_L)
    run_of(S_NUMBER, IN_N)
    run_of(S_OTHER, IN_O)
    step[S_LETTER, MORE1], step[S_LETTER, MORE2] = FRESH, MORE1
    begins[S_LETTER, [MORE1, MORE2]] = False
    for symbol, after in ((S_SHORT, MORE1), (S_LONG, MORE2)):
        step[symbol] = after
        step[symbol, [IN_O, FRONT]] = IN_O
        begins[symbol, [IN_O, FRONT]] = False
    step[S_BLANK] = FRONT
    step[S_LAST] = FRESH
    step[S_SPACE] = IN_S
    begins[S_SPACE, IN_S] = False
    step[8:] = step[:8, [FRESH]]
    return step.ravel(), begins.ravel()


STEP, BEGINS = _automaton()


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point, as the tokenizer library's own tables have it.

    The library is asked once for the letters, numbers and white space among
    all code points, so that both follow one version of Unicode.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(probe.encode_ordinary(every)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return table


def symbols(points: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbol of every code point; ``first``: where texts begin."""
    n = len(points)
    out = classes[points]
    text_end = np.zeros(n, bool)
    text_end[first[1:] - 1] = True
    text_end[-1] = True
    space = out == SPACE
    before_word = np.zeros(n, bool)
    before_word[:-1] = ~space[1:]
    before_word &= ~text_end
    out[space] = S_SPACE
    out[space & before_word] = S_LAST
    out[space & before_word & (points == 0x20)] = S_BLANK
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        ends = np.append(np.flatnonzero(text_end), n)
        left = ends[np.searchsorted(ends, quote)] - quote  # characters after it in its text
        ahead = np.append(points, [0, 0])
        one = np.where(left >= 1, ahead[np.minimum(quote + 1, n)], 0)
        two = np.where(left >= 2, ahead[np.minimum(quote + 2, n + 1)], 0)
        # The contractions.
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        out[quote[pair]] = S_LONG
        out[quote[short]] = S_SHORT
    out[first] += 8
    return out


def scan(syms: np.ndarray) -> np.ndarray:
    """Mark where pre-tokens begin, by a blocked scan of transition functions."""
    n = len(syms)
    rows = -(-n // BLOCK)
    padded = np.full(rows * BLOCK, S_SPACE, np.uint8)
    padded[:n] = syms
    # Column j holds the j-th symbol of every block, as an offset into STEP.
    columns = np.ascontiguousarray(padded.reshape(rows, BLOCK).T) * np.uint8(8)
    functions = np.tile(np.arange(8, dtype=np.uint8)[:, None], (1, rows))
    for column in columns:
        functions = STEP[column + functions]
    # The state in front of each block: functions of all blocks before it.
    reach = 1
    while reach < rows:
        functions[:, reach:] = np.take_along_axis(
            functions[:, reach:], functions[:, :-reach].astype(np.intp), 0
        )
        reach *= 2
    state = np.empty(rows, np.uint8)
    state[0] = FRESH
    state[1:] = functions[FRESH, :-1]
    begins = np.empty((BLOCK, rows), bool)
    for j, column in enumerate(columns):
        at = column + state
        begins[j] = BEGINS[at]
        state = STEP[at]
    return begins.T.reshape(-1)[:n]


def pretokens(texts: list[str], classes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """UTF-8 of all texts, the byte offset of each pre-token (and of the end), pre-tokens by text."""
    joined = "".join(texts)
    raw = joined.encode()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    if not joined:
        return raw, np.zeros(1, np.int64), np.zeros(len(texts), np.int64)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum(lengths)
    first = (ends - lengths)[lengths > 0]
    starts = np.flatnonzero(scan(symbols(points, first, classes)))
    counts = np.diff(np.searchsorted(starts, np.append(0, ends)))
    if len(raw) != len(points):
        width = np.ones(len(points) + 1, np.int64)
        for limit in (0x80, 0x800, 0x10000):
            width[1:] += points >= limit
        width[0] = 0
        starts = np.cumsum(width)[starts]
    return raw, np.append(starts, len(raw)), counts


# --- merging ---------------------------------------------------------------


def merge_pairs(piece: bytes, ranks: Mapping[bytes, int]) -> list[int]:
    """Ids of one slice: the pair of lowest rank is merged first, the leftmost of equal ones."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) >= LONG_SLICE:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    get = ranks.get
    none = len(ranks) + (1 << 40)
    pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[part] for part in parts]


def _merge_long(piece: bytes, ranks: Mapping[bytes, int]) -> list[int]:
    """The same with a heap over a linked list: n log n for slices of any length."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here; 0: merged away
    before = list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if end[i] < n:
            stop = end[end[i]]
            rank = ranks.get(piece[i:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, i, stop))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not end[i] or end[i] >= n or end[end[i]] != stop:
            continue
        gone = end[i]
        end[i], end[gone] = stop, 0
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class _Cache(dict):
    """Slice -> its ids as little-endian unsigned 32-bit integers.

    When it is full it becomes the older half, from which slices still in use return.
    """

    def __init__(self, ranks: Mapping[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = np.array(merge_pairs(piece, self.ranks), "<u4").tobytes()
            if len(piece) > 256:  # hardly repeats
                return ids
        if len(self) >= MAX_CACHE:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


# One per Python worker, kept from task to task; the key is the broadcast's id.
_workers: dict[int, tuple] = {}


def _worker(shared) -> tuple:
    key = shared._jbroadcast.id() if getattr(shared, "_jbroadcast", None) else id(shared)
    if key not in _workers:
        _workers.clear()
        ranks, classes = shared.value
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        lengths = np.fromiter(map(len, table), np.int64, len(table))
        _workers[key] = (_Cache(ranks), classes, table, lengths)
    return _workers[key]


def _bytes_of(line: bytes | None, table: list[bytes]) -> bytes:
    """The bytes of packed ids."""
    return b"".join(map(table.__getitem__, np.frombuffer(line or b"", "<u4").tolist()))


# --- operators -------------------------------------------------------------


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a vocabulary file (base64 of the token, blank, rank)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


class ByteBPE:
    """A vocabulary, broadcast once; its size is that of the file, not of the data."""

    def __init__(self, spark, path: str):
        ranks = load_ranks(path)
        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"vocabulary without the bytes {missing}")
        self._shared = spark.sparkContext.broadcast((ranks, class_table()))

    def encode(
        self,
        df: DataFrame,
        text: str = "text",
        ids: str = "ids",
        offsets: str = "offsets",
        count: str = "n_tokens",
        decoded: str | None = None,
    ) -> DataFrame:
        """Add token ids, their byte offsets and their number to every row.

        ``ids`` and ``offsets`` are binary: little-endian unsigned 32-bit
        integers, one for each token; an offset is where the token begins in
        the UTF-8 of the text. With ``decoded`` the ids are decoded again in the
        same pass, into that column. A null text is encoded as an empty one: no ids.
        Whole texts of any length are encoded, rows that repeat each on their
        own. Columns named like an output are replaced, all others are kept.
        """
        shared = self._shared

        def compute(texts: list) -> list[pa.Array]:
            cache, classes, table, lengths = _worker(shared)
            raw, edges, counts = pretokens([t or "" for t in texts], classes)
            edges = edges.tolist()
            coded = [cache[raw[a:b]] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            out_ids, out_offsets, numbers, at = [], [], [], 0
            for n in counts.tolist():
                line = b"".join(coded[at : at + n])
                at += n
                tokens = np.frombuffer(line, "<u4")
                ends = np.cumsum(lengths[tokens])
                out_ids.append(line)
                out_offsets.append((ends - lengths[tokens]).astype("<u4").tobytes())
                numbers.append(len(tokens))
            made = [packed(out_ids), packed(out_offsets), pa.array(numbers, pa.int64())]
            return made + [packed([_bytes_of(x, table) for x in out_ids])] * bool(decoded)

        outputs = f"`{ids}` binary, `{offsets}` binary, `{count}` bigint"
        outputs += f", `{decoded}` binary" if decoded else ""
        return add_columns(df, text, outputs, compute)

    def decode(
        self,
        df: DataFrame,
        ids: str = "ids",
        decoded: str = "decoded",
        offsets: str | None = None,
    ) -> DataFrame:
        """Add the bytes of the tokens in ``ids``; null ids give no bytes.

        An id outside the vocabulary fails. With ``offsets`` each token has to
        begin where its offset says, or the row fails. Columns named like the
        output are replaced.
        """
        shared = self._shared

        def compute(lines: list, places: list | None = None) -> list[pa.Array]:
            _, _, table, lengths = _worker(shared)
            out = []
            for k, line in enumerate(lines):
                tokens = np.frombuffer(line or b"", "<u4")
                if places is not None:
                    sizes = lengths[tokens]
                    begin = (np.cumsum(sizes) - sizes).astype("<u4")
                    if begin.tobytes() != (places[k] or b""):
                        raise ValueError("offsets do not belong to the ids")
                out.append(_bytes_of(line, table))
            return [packed(out)]

        more = [offsets] if offsets else []
        return add_columns(df, ids, f"`{decoded}` binary", compute, *more)


def digests(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Key, number of tokens and SHA-256 of ids and decoded bytes."""
    return df.select(
        key,
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


