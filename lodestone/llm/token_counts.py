"""Exact token counts of a byte-level BPE tokenizer: a finite-state splitter and a memoised merge loop.

A deterministic transducer, compiled from the tokenizer's file, reads character classes and marks where
pre-tokens begin. It runs over a whole batch in lanes of equal length: each lane is read once from every state, which gives
its state map; the maps are composed by a parallel prefix scan, which gives each lane's true first state; then every lane is read
from that state. The tokens of a pre-token are counted by no transducer: an ordinary heap of merges is run over it when it is first
met, and the count is kept by the whole pre-token. Merges go by rank anywhere in a pre-token, not from left to right, and have not been
compiled into transitions that emit counts.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# -- character classes ---------------------------------------------------------------------------

OTHER, LETTER, NUMBER, BLANK, SPACE, QUOTE, C1, CR, CL, CE, END = range(11)
# S t m d, a whole contraction after a quote. CR: r v, which need e. CL: l, which needs l. CE: e.
_SPECIAL = {" ": BLANK, "'": QUOTE, "s": C1, "t": C1, "m": C1, "d": C1, "r": CR, "v": CR, "l": CL, "e": CE}
_LETTERS = {LETTER, C1, CR, CL, CE}
_SPACES = {BLANK, SPACE}

BEGIN, IN_LETTERS, IN_NUMBERS, IN_OTHER, BLANK1, SPACE1, BLANKS, SPACES, APOSTROPHE, APO_R, APO_L, SHORT = range(12)
STATES, CLASSES = 12, 16
HERE, BEFORE = 1, 2  # a pre-token begins at this character, at the one before


def _open(c: int) -> int:
    """State after a pre-token's first character."""
    if c in _LETTERS:
        return IN_LETTERS
    return {NUMBER: IN_NUMBERS, OTHER: IN_OTHER, BLANK: BLANK1, SPACE: SPACE1, QUOTE: APOSTROPHE, END: BEGIN}[c]


def _inside(state: int, c: int) -> bool:
    """Whether a run of letters, numbers or other signs goes on."""
    if state == IN_LETTERS:
        return c in _LETTERS
    if state == IN_NUMBERS:
        return c == NUMBER
    return state == IN_OTHER and c in (OTHER, QUOTE)


def _joined(c: int) -> int:
    """State of a run that takes the blank before it."""
    return IN_OTHER if c == QUOTE else _open(c)


def _move(state: int, c: int) -> tuple[int, int]:
    if c == END:  # end of a text or a special token: white space stays whole
        return BEGIN, HERE | (BEFORE if state in (APO_R, APO_L) else 0)
    if _inside(state, c):
        return state, 0
    if state in (BLANK1, SPACE1, BLANKS, SPACES):
        if c in _SPACES:
            return (BLANKS if c == BLANK else SPACES), 0
        if state == BLANK1:
            return _joined(c), 0
        if state == SPACE1:
            return _open(c), HERE
        if state == BLANKS:  # the last blank leaves the run and joins what follows
            return _joined(c), BEFORE
        return _open(c), HERE | BEFORE
    if state == APOSTROPHE:
        if c == C1:
            return SHORT, 0
        if c == CR:
            return APO_R, 0
        if c == CL:
            return APO_L, 0
        if c in (OTHER, QUOTE):
            return IN_OTHER, 0
    if (state, c) in ((APO_R, CE), (APO_L, CL)):
        return SHORT, 0
    if state in (APO_R, APO_L):  # no contraction: the quote stands alone, the letter begins a run
        return (IN_LETTERS, BEFORE) if c in _LETTERS else (_open(c), HERE | BEFORE)
    return _open(c), HERE


def _tables() -> tuple[np.ndarray, np.ndarray]:
    to, out = np.zeros(STATES * CLASSES, np.uint8), np.zeros(STATES * CLASSES, np.uint8)
    for s in range(STATES):
        for c in range(END + 1):
            to[s * CLASSES + c], out[s * CLASSES + c] = _move(s, c)
    return to, out


NEXT, EMIT = _tables()


def character_classes(path: str) -> np.ndarray:
    """Class of every code point, asked from the library's own pre-tokenizer, so both use one Unicode version.

    A block of 256 code points that makes one pre-token is of one class and is asked once; the others by character.
    """
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    size = lambda text: len(split(text))

    def kind(ch: str) -> int:
        if size("a" + ch) == 1:
            return LETTER
        if size("1" + ch) == 1:
            return NUMBER
        return OTHER if size("!" + ch) == 1 else SPACE

    table = np.full(0x110000, OTHER, np.uint8)
    for at in range(0, 0x110000, 256):
        if 0xD800 <= at < 0xE000:
            continue
        block = [chr(p) for p in range(at, at + 256)]
        if size("".join(block)) == 1:
            table[at : at + 256] = kind(block[0])
        else:
            table[at : at + 256] = [kind(ch) for ch in block]
    for ch, c in _SPECIAL.items():
        table[ord(ch)] = c
    return table


# -- the splitter over lanes ---------------------------------------------------------------------


def compose(maps: np.ndarray) -> np.ndarray:
    """Prefix scan: row i becomes the map of lanes 0..i, in log2(lanes) rounds."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], axis=1)
        step *= 2
    return out


def boundaries(classes: np.ndarray, lane: int = 1024) -> np.ndarray:
    """For each character whether a pre-token begins there."""
    n = len(classes)
    lane = max(1, min(lane, n))
    lanes = -(-n // lane)
    padded = np.full(lanes * lane, END, np.uint8)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(lanes, lane).T)
    state = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], lanes, axis=1)
    for c in columns:
        state = NEXT[(state << 4) | c]
    scanned = compose(np.ascontiguousarray(state.T))
    now = np.full(lanes, BEGIN, np.uint8)
    now[1:] = scanned[:-1, BEGIN]
    emitted = np.empty_like(columns)
    for i, c in enumerate(columns):
        at = (now << 4) | c
        emitted[i], now = EMIT[at], NEXT[at]
    flat = np.ascontiguousarray(emitted.T).ravel()[:n]
    begins = (flat & HERE).astype(bool)
    begins[:-1] |= (flat[1:] & BEFORE).astype(bool)
    return begins


# -- the counter of one pre-token -----------------------------------------------------------------


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the tokenizer's file: itself, or the next one from 256 on."""
    shown = [b for a, z in ((33, 126), (161, 172), (174, 255)) for b in range(a, z + 1)]
    letters, extra = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


class PieceCounter(dict):
    """Number of tokens by pre-token; unknown ones are compiled from the merge list, and at most ``bound`` are kept."""

    def __init__(self, ranks: dict[tuple[str, str], int], bound: int = 300_000):
        super().__init__()
        self.ranks, self.bound, self.letters = ranks, bound, _byte_letters()

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.bound:
            self.clear()
        n = self[piece] = self._count(piece)
        return n

    def _count(self, piece: str) -> int:
        part: list[str | None] = [self.letters[b] for b in piece.encode("utf-8", "surrogatepass")]
        n, rank = len(part), self.ranks.get
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := rank((part[i], part[i + 1]))) is not None]
        heapq.heapify(heap)
        tokens = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if part[i] != a or j >= n or part[j] != b:
                continue  # one of the two was merged meanwhile
            part[i], part[j] = a + b, None
            tokens -= 1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := rank((part[i], part[k]))) is not None:
                    heapq.heappush(heap, (r, i, part[i], part[k]))
            if (h := left[i]) >= 0 and (r := rank((part[h], part[i]))) is not None:
                heapq.heappush(heap, (r, h, part[h], part[i]))
        return tokens


class Counter:
    """Token counts of texts, compiled from a tokenizer's file."""

    def __init__(self, path: str, classes: np.ndarray):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"])
        self.pieces = PieceCounter({p: i for i, p in enumerate(pairs)})
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.classes = classes

    def __call__(self, texts: list[str]) -> np.ndarray:
        counts = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        for i, text in enumerate(texts):
            rest = [text]
            for special in self.added:
                cutup = [p.split(special) for p in rest]
                counts[i] += sum(len(p) - 1 for p in cutup)
                rest = [x for p in cutup for x in p]
            parts += rest
            owner += [i] * len(rest)
        whole = "\n".join(parts) + "\n"
        codes = self.classes[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)]
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        codes[ends] = END
        starts = np.flatnonzero(boundaries(codes))
        stops = np.append(starts[1:], len(whole))
        real = codes[starts] != END
        starts, stops = starts[real], stops[real]
        pieces = [whole[a:b] for a, b in zip(starts.tolist(), stops.tolist())]
        n = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))
        at = np.asarray(owner)[np.searchsorted(ends, starts)]
        return counts + np.bincount(at, weights=n, minlength=len(texts)).astype(np.int64)


_COUNTERS: dict[str, Counter] = {}  # one per worker process and file; the compiled paths serve later tasks too


def token_count(spark, text: Column, path: str, block: int = 1 << 21) -> Column:
    """A column with the number of tokens of ``text``; null counts as empty. ``path`` must exist on every executor."""
    shared = spark.sparkContext.broadcast(character_classes(path))

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _COUNTERS.get(path)
        if counter is None:
            counter = _COUNTERS[path] = Counter(path, shared.value)
        for batch in batches:
            out = np.zeros(len(batch), np.int64)
            held, size = [], 0
            for i, t in enumerate(batch):
                if t:
                    held.append((i, t))
                    size += len(t)
                if held and (size >= block or i + 1 == len(batch)):
                    out[[k for k, _ in held]] = counter([t for _, t in held])
                    held, size = [], 0
            if held:
                out[[k for k, _ in held]] = counter([t for _, t in held])
            yield pd.Series(out)

    # with the annotations of this module as strings, the kind of function is named by its hints
    count.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(count, "bigint")(text)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_bytes, n_tokens, over_limit``.

    A null or empty text has 0 bytes and 0 tokens. Null ids and repeated rows stay as they are, one row each. Other columns
    are not read. A very long text is one row and is read in lanes; a text is never cut. No shuffle.
    """
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(docs.sparkSession, text, path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
