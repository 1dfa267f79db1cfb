"""Operator 1: SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut into words that no piece of the vocabulary crosses (a run of
spaces and what follows it). The distinct words of a batch lie behind each other
in one flat numpy array of symbols. One round finds the smallest pair rank of
every word (a segmented minimum), merges the leftmost non-overlapping
occurrences of that pair in all words at once, and closes the gaps; rounds go on
until no pair remains. The ids of a text are those of its words in order.

The model is read once on the driver with the sentencepiece library's own
protobuf; executors get plain arrays (a few MB, bounded by the vocabulary).

Defined results: a null text counts as empty; an empty text has no ids and
decodes to an empty text; characters outside the vocabulary become their UTF-8
byte pieces; repeated rows are encoded each; other columns of the input pass
through ``encode``/``decode`` unless their name is that of a new column, which
replaces them; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stockyard.llm.common import binary_parts, text_slices

_NONE = np.int32(2**31 - 1)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_UNITS = re.compile(" +[^ ]*")
SLICE_BYTES = 2 << 20  # of text encoded at a time: the arrays made of them are many times as large


@dataclass(frozen=True)
class Tables:
    """A BPE model as arrays. Pairs lie in an open-addressing hash table."""

    n_pieces: int
    char_id: np.ndarray  # code point -> id of the one-character piece, or -1
    slots: np.ndarray  # pair key left * n_pieces + right, or -1
    slot_rank: np.ndarray  # order of the merged piece by score; equal scores share one
    slot_id: np.ndarray  # merged piece
    shift: int
    lone: np.ndarray  # by rank: merge only the leftmost occurrence in a round
    tie_rank: int  # the one rank that several pieces share (runs of spaces), or -1
    byte_id: np.ndarray  # id of each byte piece
    piece: list[bytes]  # decoded bytes of each id
    is_byte: np.ndarray


def load(model_path: str) -> Tables:
    """Read a BPE model with identity normalisation, a dummy prefix and byte fallback."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(model_path, "rb") as f:
        m.ParseFromString(f.read())
    norm = m.normalizer_spec
    if m.trainer_spec.model_type != 2 or not m.trainer_spec.byte_fallback:
        raise ValueError("only BPE models with byte fallback")
    if norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces:
        raise ValueError("only identity normalisation with a dummy prefix")
    if any(p.type in (4, 5) for p in m.pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    n = len(m.pieces)
    normal = {p.piece: i for i, p in enumerate(m.pieces) if p.type == 1}
    if any("▁" in p.lstrip("▁") for p in normal):
        raise ValueError("a piece crosses a word border")
    scores = sorted({-m.pieces[i].score for i in normal.values()})
    rank_of = {s: k for k, s in enumerate(scores)}
    rank = {i: rank_of[-m.pieces[i].score] for i in normal.values()}
    pairs = {}
    for p, i in normal.items():
        for k in range(1, len(p)):
            a, b = normal.get(p[:k]), normal.get(p[k:])
            if a is not None and b is not None:
                pairs[a * n + b] = (rank[i], i)
    merged = {i for _, i in pairs.values()}
    by_rank: dict[int, list[int]] = {}
    for i in merged:
        by_rank.setdefault(rank[i], []).append(i)
    shared = [r for r, ids in by_rank.items() if len(ids) > 1]
    blank = {i for p, i in normal.items() if not p.strip("▁")}
    if len(shared) > 1 or any(i not in blank for r in shared for i in by_rank[r]):
        raise ValueError("pieces of equal score are supported for runs of spaces only")
    if shared and any(r > shared[0] for r, _ in pairs.values()):
        raise ValueError("runs of spaces must have the lowest score")
    # A piece whose merge opens a better pair: its occurrences go one at a time.
    lone = np.zeros(len(scores) + 1, bool)
    for key, (r, _) in pairs.items():
        for part in divmod(key, n):
            if part in merged and r < rank[part]:
                lone[rank[part]] = True
    keys = np.fromiter(pairs, np.int64, len(pairs))
    bits = max(4, int(np.ceil(np.log2(len(keys) + 1))) + 2)
    slots = np.full((1 << bits) + 64, -1, np.int64)
    s_rank, s_id = np.full(len(slots), _NONE, np.int32), np.full(len(slots), -1, np.int32)
    for key in pairs:  # linear probing
        at = ((key * int(_MULT)) & (2**64 - 1)) >> (64 - bits)
        while slots[at] >= 0:
            at += 1
        slots[at] = key
        s_rank[at], s_id[at] = pairs[key]
    char_id = np.full(0x110000, -1, np.int32)
    for p, i in normal.items():
        if len(p) == 1:
            char_id[ord(" " if p == "▁" else p)] = i
    char_id[0x2581] = char_id[0x20]
    byte_id = np.full(256, -1, np.int32)
    is_byte = np.zeros(n, bool)
    piece: list[bytes] = []
    for i, p in enumerate(m.pieces):
        if p.type == 6:
            b = int(p.piece[3:5], 16)
            byte_id[b], is_byte[i] = i, True
            piece.append(bytes([b]))
        elif p.type == 1:
            piece.append(p.piece.replace("▁", " ").encode())
        else:  # unknown: as the library prints it; control pieces: nothing
            piece.append((m.trainer_spec.unk_surface or " ⁇ ").encode() if p.type == 2 else b"")
    return Tables(n, char_id, slots, s_rank, s_id, 64 - bits, lone, shared[0] if shared else -1, byte_id, piece, is_byte)


def _lookup(t: Tables, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Slots of pairs in the hash table; an empty slot where there is no such pair."""
    key = left.astype(np.int64) * t.n_pieces + right
    key[(left < 0) | (right < 0)] = -2
    at = ((key.astype(np.uint64) * _MULT) >> np.uint64(t.shift)).astype(np.int64)
    found = t.slots[at]
    rest = np.flatnonzero((found != key) & (found >= 0))
    while len(rest):
        at[rest] += 1
        found = t.slots[at[rest]]
        rest = rest[(found != key[rest]) & (found >= 0)]
    return at


def _tie_pass(t: Tables, symbols: list[int]) -> list[int]:
    """Pairs of equal, lowest score merge leftmost first: a stack does that in one pass."""
    out: list[int] = []
    for x in symbols:
        out.append(x)
        while len(out) > 1:
            at = _lookup(t, np.array(out[-2:-1], np.int32), np.array(out[-1:], np.int32))[0]
            if t.slot_rank[at] == _NONE:
                break
            out[-2:] = [int(t.slot_id[at])]
    return out


def merge_words(t: Tables, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the symbols of many words (``word``: ascending word of each symbol) until
    no pair remains; returns the remaining symbols and their words, in order."""
    done_s, done_w = [], []
    s, w = symbols, word
    rank = np.full(len(s), _NONE, np.int32)
    slot = np.zeros(len(s), np.int64)
    fresh = np.arange(max(0, len(s) - 1))
    while len(s):
        if len(fresh):
            fresh = fresh[(fresh >= 0) & (fresh < len(s) - 1)]
            at = _lookup(t, s[fresh], s[fresh + 1])
            slot[fresh] = at
            rank[fresh] = np.where(w[fresh] == w[fresh + 1], t.slot_rank[at], _NONE)
        starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        least = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.r_[starts, len(s)])
        tied = least == t.tie_rank
        if tied.any():  # only runs of spaces are left to merge in these words
            for k in np.flatnonzero(tied):
                got = _tie_pass(t, s[starts[k] : starts[k] + sizes[k]].tolist())
                done_s.append(np.array(got, np.int32))
                done_w.append(np.full(len(got), w[starts[k]], np.int32))
        over = (least == _NONE) | tied
        if over.any():
            out = np.repeat(least == _NONE, sizes)
            done_s.append(s[out])
            done_w.append(w[out])
            stay = ~np.repeat(over, sizes)
            s, w, rank, slot = s[stay], w[stay], rank[stay], slot[stay]
            least, sizes = least[~over], sizes[~over]
            if not len(s):
                break
            starts = np.cumsum(sizes) - sizes
        hit = np.flatnonzero(rank == np.repeat(least, sizes))
        # Leftmost, non-overlapping: of positions in a row, every other one from the first.
        fresh_run = np.r_[True, np.diff(hit) != 1]
        run_at = np.maximum.accumulate(np.where(fresh_run, np.arange(len(hit)), 0))
        take = (np.arange(len(hit)) - run_at) % 2 == 0
        single = t.lone[rank[hit]]
        if single.any():
            take &= ~single | np.r_[True, w[hit[1:]] != w[hit[:-1]]]
        hit = hit[take]
        s[hit] = t.slot_id[slot[hit]]
        keep = np.ones(len(s), bool)
        keep[hit + 1] = False
        at = hit - np.arange(len(hit))  # places after closing the gaps
        s, w, rank, slot = s[keep], w[keep], rank[keep], slot[keep]
        fresh = np.concatenate([at, at - 1])
        rank[at] = _NONE  # the last symbol of the array has no pair
    if not done_s:
        return s, w
    s, w = np.concatenate(done_s), np.concatenate(done_w)
    order = np.argsort(w, kind="stable")
    return s[order], w[order]


def encode_words(t: Tables, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words (each without its first space): flat ids, offsets."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    _, raw = binary_parts(pc.binary_join_element_wise(" ", words, ""))
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    word = np.repeat(np.arange(n, dtype=np.int32), lengths)
    symbols = t.char_id[points]
    strange = symbols < 0
    symbols[strange] = -1 - points[strange].astype(np.int32)  # no pair has a negative symbol
    ids, word = merge_words(t, symbols, word)
    if (ids < 0).any():  # byte fallback
        counts = np.ones(len(ids), np.int64)
        at = np.flatnonzero(ids < 0)
        raw = [chr(-1 - c).encode() for c in ids[at].tolist()]
        counts[at] = [len(x) for x in raw]
        start = np.cumsum(counts) - counts
        out = np.repeat(ids, counts)
        places = np.repeat(start[at] - (np.cumsum(counts[at]) - counts[at]), counts[at]) + np.arange(counts[at].sum())
        out[places] = t.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        ids, word = out, np.repeat(word, counts)
    offsets = np.r_[0, np.cumsum(np.bincount(word, minlength=n))]
    return ids, offsets


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in a row and their number per text. A word is a run of
    spaces and what follows, without its first space (the first word's is the dummy
    prefix); the mark U+2581 counts as a space; an empty text has no word."""
    empty = np.asarray(pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), bool)
    odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")), pc.match_substring(texts, "▁"))
    lists = pc.split_pattern(texts, " ")
    if pc.any(odd).as_py():
        own = odd.to_numpy(zero_copy_only=False).astype(bool)
        parts = lists.to_pylist()
        for k in np.flatnonzero(own):
            parts[k] = [u[1:] for u in _UNITS.findall(" " + texts[k].as_py().replace("▁", " "))]
        lists = pa.array(parts, pa.list_(pa.string()))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten()
    if empty.any():
        words = words.filter(pa.array(~np.repeat(empty, counts)))
        counts[empty] = 0
    return words, counts


@dataclass
class Encoded:
    """Ids of a batch: those of the distinct words, and each text's words."""

    ids: np.ndarray
    offsets: np.ndarray
    word: np.ndarray  # index of the distinct word, for all texts in a row
    counts: np.ndarray  # words per text


class Memo:
    """Ids of words met before in this task, at most ``limit`` of them."""

    def __init__(self, limit: int = 200_000):
        self.limit, self.words = limit, pa.array([], pa.string())
        self.ids, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode(self, t: Tables, words: pa.Array, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_words``; remembers new words marked in ``often``."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(at < 0)
        ids, offsets = encode_words(t, words.take(pa.array(new)))
        old = len(self.words)
        place = at.astype(np.int64)
        place[new] = old + np.arange(len(new))
        all_ids = np.concatenate([self.ids, ids])
        starts = np.concatenate([self.offsets[:-1], offsets[:-1] + self.offsets[-1]])
        sizes = np.concatenate([np.diff(self.offsets), np.diff(offsets)])
        keep = new[often[new]][: max(0, self.limit - old)]
        got_sizes = sizes[place]
        ends = np.cumsum(got_sizes)
        flat = all_ids[np.repeat(starts[place] - (ends - got_sizes), got_sizes) + np.arange(ends[-1] if len(ends) else 0)]
        if len(keep):
            p = place[keep]
            e = np.cumsum(sizes[p])
            add = all_ids[np.repeat(starts[p] - (e - sizes[p]), sizes[p]) + np.arange(e[-1])]
            self.words = pa.concat_arrays([self.words, words.take(pa.array(keep))])
            self.ids = np.concatenate([self.ids, add])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + e])
        return flat, np.r_[0, ends]


def encode_texts(t: Tables, texts: pa.Array, memo: Memo | None = None) -> Encoded:
    words, counts = split_words(texts)
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    distinct = coded.dictionary.cast(pa.string())
    if memo is None:
        ids, offsets = encode_words(t, distinct)
    else:
        ids, offsets = memo.encode(t, distinct, np.bincount(index, minlength=len(distinct)) > 1)
    return Encoded(ids, offsets, index, counts)


def _joined(parts: pa.Array, e: Encoded) -> tuple[np.ndarray, bytes]:
    """Concatenate one binary part per id into one run per text: offsets and bytes."""
    per_id = parts.take(pa.array(e.ids))
    off, raw = binary_parts(per_id)
    per_word = pa.Array.from_buffers(
        pa.binary(), len(e.offsets) - 1, [None, pa.py_buffer(off[e.offsets].astype(np.int32)), pa.py_buffer(raw)]
    )
    off, raw = binary_parts(per_word.take(pa.array(e.word)))
    ends = np.r_[0, np.cumsum(e.counts)]
    return off[ends], raw.tobytes()


def decode_ids(t: Tables, ids: Iterable[int]) -> str:
    """What the library's ``decode`` gives: pieces in a row without the dummy prefix;
    byte pieces are read as UTF-8, each byte that is not as U+FFFD."""
    ids = list(ids)
    raw = b"".join(t.piece[i] for i in ids)
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        text, run = "", b""
        for i in [*ids, None]:
            if i is not None and t.is_byte[i]:
                run += t.piece[i]
                continue
            text += _valid(run)
            run = b""
            text += t.piece[i].decode() if i is not None else ""
    first = next((i for i in ids if t.piece[i]), None)
    return text[1:] if first is not None and not t.is_byte[first] and t.piece[first][:1] == b" " and first != 0 else text


def _valid(run: bytes) -> str:
    out, at = "", 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out += run[at : at + n].decode()
                at += n
                break
            except UnicodeDecodeError:
                if n == 4 or at + n >= len(run):
                    out += "�"
                    at += 1
                    break
    return out


def _sha(data) -> str:
    return hashlib.sha256(data).hexdigest()


def _with(schema: T.StructType, new: T.StructType) -> T.StructType:
    names = {f.name.lower() for f in new}
    return T.StructType([f for f in schema if f.name.lower() not in names] + list(new))


def _mapped(df: DataFrame, model_path: str, col: str, new: T.StructType, fn, without: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the columns ``new`` that ``fn`` makes of ``col``; those in ``without`` are not put out."""
    box = df.sparkSession.sparkContext.broadcast(load(model_path))
    schema = _with(T.StructType([f for f in df.schema if f.name not in without]), new)
    kept = [f.name for f in schema][: len(schema) - len(new)]
    names = list(schema.names)
    texts = not isinstance(df.schema[col].dataType, T.ArrayType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, memo = box.value, Memo()
        for b in text_slices(batches, col, SLICE_BYTES) if texts else batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(k) for k in kept] + fn(t, memo, b.column(col)), names=names)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, model_path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out`` (array of int): the ids of ``text``, without begin or end ids."""

    def ids(t: Tables, memo: Memo, texts: pa.Array) -> list[pa.Array]:
        e = encode_texts(t, pc.fill_null(texts, ""), memo)
        n = np.diff(e.offsets)[e.word]
        first = np.repeat(e.offsets[e.word] - (np.cumsum(n) - n), n)
        flat = e.ids[first + np.arange(n.sum())] if len(n) else np.zeros(0, np.int32)
        ends = np.r_[0, np.cumsum(n)][np.r_[0, np.cumsum(e.counts)]]
        return [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.astype(np.int32)))]

    return _mapped(df, model_path, text, T.StructType().add(out, T.ArrayType(T.IntegerType())), ids)


def decode(df: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out`` (string): the text of the id array ``ids`` (null: empty)."""

    def texts(t: Tables, _: Memo, lists: pa.Array) -> list[pa.Array]:
        return [pa.array([decode_ids(t, x or []) for x in lists.to_pylist()], pa.string())]

    return _mapped(df, model_path, ids, T.StructType().add(out, T.StringType()), texts)


def round_trip_digest(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """Encode and decode ``text``; adds n_tokens, ids_sha256 (ids in decimal, joined by
    commas) and decoded_sha256, in place of ``text``."""
    new = T.StructType().add("n_tokens", T.LongType()).add("ids_sha256", T.StringType()).add("decoded_sha256", T.StringType())
    keep = [c for c in df.columns if c != text]

    def digest(t: Tables, memo: Memo, texts: pa.Array) -> list[pa.Array]:
        e = encode_texts(t, pc.fill_null(texts, ""), memo)
        per_word = np.r_[0, np.cumsum(np.diff(e.offsets)[e.word])]
        ends = np.r_[0, np.cumsum(e.counts)]
        n_tokens = np.diff(per_word[ends])
        numbers = pa.array([b"%d," % i for i in range(t.n_pieces)], pa.binary())
        off, raw = _joined(numbers, e)
        view = memoryview(raw)
        sha_ids = [_sha(view[a : max(a, b - 1)]) for a, b in zip(off.tolist(), off[1:].tolist())]
        off, raw = _joined(pa.array(t.piece, pa.binary()), e)
        view = memoryview(raw)
        # A text's first piece starts with the dummy prefix, which decoding drops; its
        # bytes are those of valid UTF-8, so byte pieces need no repair here.
        sha_text = [_sha(view[min(a + 1, b) : b]) for a, b in zip(off.tolist(), off[1:].tolist())]
        return [pa.array(n_tokens.astype(np.int64)), pa.array(sha_ids, pa.string()), pa.array(sha_text, pa.string())]

    return _mapped(df, model_path, text, new, digest, without=(text,)).select(*keep, *new.names)
