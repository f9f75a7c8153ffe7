"""What several operators share: texts as arrays of bytes and words, and batches of a bounded size."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from wardwatch.session import ship

ship(__name__)
ship("wardwatch.session")

#: Rows that Spark hands to Python at a time. Texts may be long, so this is far below Spark's default.
ROWS_AT_ONCE = "500"
#: Bytes of text that are turned into arrays at a time.
BYTES_AT_ONCE = 1 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """Set the session's Arrow batches to a size that long texts allow."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)
    return df


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(run, schema)


def split_words(text: bytes) -> list[bytes]:
    """Runs of bytes other than space and the control characters from tab to carriage return."""
    return text.split()  # bytes.split() cuts at exactly these six


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text, empty for null."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def groups_of(texts: list[bytes], most: int = BYTES_AT_ONCE) -> Iterator[range]:
    """Neighbouring texts, together about `most` bytes; a longer text is alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield range(start, i)
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield range(start, len(texts))


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64 bits that spreads them (finaliser of a public hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def lower_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text in lower case, empty for null; ill-formed sequences become replacement characters first."""
    try:
        return texts_of(pc.utf8_lower(column))
    except pa.ArrowInvalid:
        sound = [t.decode("utf-8", "replace") for t in texts_of(column)]
        return texts_of(pc.utf8_lower(pa.array(sound, pa.string())))


#: Odd, so that it has an inverse modulo 2**64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = mix64(np.arange(1, 257, dtype=np.uint64))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of a fixed odd number, or of its inverse, modulo 2**64."""
    name = "inverse" if inverse else "base"
    known = _POWERS.get(name)
    if known is None or len(known) < n:
        factors = np.full(max(n, BYTES_AT_ONCE + 1), _INVERSE if inverse else _BASE)
        factors[0] = 1
        known = _POWERS[name] = np.cumprod(factors, dtype=np.uint64)
    return known[:n]


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Running sums of symbol times power; one more entry than symbols."""
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * powers(len(symbols)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the symbols from start to stop, the same wherever they stand."""
    return mix64((prefix[stop] - prefix[start]) * powers(len(prefix), inverse=True)[start] + (stop - start).astype(np.uint64))


#: Longer words are hashed by a digest: from some 1,000 letters on there are words that powers modulo 2**64 confuse.
LONG_WORD = 256
#: For each byte, whether it ends a word: the six spaces; or all of ASCII but letters and digits.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
NOT_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one array of bytes, each followed by a line feed, and where each starts (one more entry)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), starts


def words_in(blob: np.ndarray, ends: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of each word of a blob that ends with a byte that ends words."""
    word = np.zeros(len(blob) + 1, np.int8)
    word[1:] = ~ends[blob]
    turns = np.diff(word)
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def word_hashes(blob: np.ndarray, start: np.ndarray, *stops: np.ndarray) -> list[np.ndarray]:
    """A 64-bit hash of the bytes from start to each of the stops (the last is the farthest), a piece of the blob at a time.

    Powers modulo 2**64 tell short words apart; there are long ones that they do not, so these take a digest.
    """
    out, at, last = [np.empty(len(start), np.uint64) for _ in stops], 0, stops[-1]
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(last, start[at] + BYTES_AT_ONCE, "right")))
        low, high = start[at], last[upto - 1]
        prefix = prefix_hash(_VALUES[blob[low:high]])
        for hashes, stop in zip(out, stops):
            hashes[at:upto] = span_hash(prefix, start[at:upto] - low, stop[at:upto] - low)
        at = upto
    for hashes, stop in zip(out, stops):
        for i in np.flatnonzero(stop - start > LONG_WORD):
            hashes[i] = int.from_bytes(hashlib.blake2b(blob[start[i] : stop[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def lockstep(counts: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The order of sequences, longest first, and how many have a step 0, 1, 2 and so on."""
    order = np.argsort(-counts, kind="stable")
    longest = int(counts.max(initial=0))
    live = len(counts) - np.searchsorted(np.sort(counts), np.arange(longest), "right")
    return order, live.tolist()
