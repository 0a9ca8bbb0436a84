"""Byte-level BPE by batched numpy merge rounds, and its decoding.

Texts are cut into words by array rules over code-point classes; equal words
are encoded once. The symbols of many words lie in one flat array. In each
round a binary search over the sorted pair keys ranks the pairs next to the
last merges, every word merges its lowest-ranked pair wherever it occurs, and
words without a mergeable pair leave the array.

Results equal the tokenizers library on the same file with
add_special_tokens=False; a special token's text becomes its id, as there.
Equal words are recognised by their bytes; hashes only find the words met before.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickcast.llm.common import U64, arrow_settings, byte_codes, mix, powers, stage, text_bytes

LETTER, NUMBER, SPACE = 1, 2, 3
LONG_WORD = 1024  # bytes; longer words are merged one by one with a heap
CACHED_WORDS = 1 << 19
CACHED_BYTES = 1 << 24
CHUNK = 1 << 20  # characters encoded at once
NO_RANK = np.int32(2**31 - 1)
WORD_BASE = 0x2545F4914F6CDD1D
# White_Space code points of Unicode.
SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def classes() -> np.ndarray:
    kind = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8, 0x110000)
    out[SPACES] = SPACE
    return out


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


def word_starts(cps: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Code-point positions at which the words begin; words stay in their text.

    A word is a run of letters, of numbers or of other signs, with one
    blank before it if there is one; an apostrophe and one of s t re ve m ll d
    at a word's beginning is a word; of other white space before a word the
    last character is one of its own.
    """
    n = len(cps)
    cls = classes()[cps]
    begin = np.zeros(n + 1, bool)
    begin[text_starts] = True
    begin[n] = True
    start = begin.copy()
    start[1:n] |= cls[1:] != cls[:-1]
    space = cls == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~begin[1:n])
    start[last] = True
    start[last[cps[last] == 0x20] + 1] = False
    quote = np.flatnonzero((cps == 0x27) & start[:n])
    if len(quote):
        pad = np.append(cps, [0, 0, 0]).astype(np.int64)
        edge = np.append(begin, [True, True, True])
        a = np.where(edge[quote + 1], 0, pad[quote + 1])
        b = np.where(edge[quote + 1] | edge[quote + 2], 0, pad[quote + 2])
        two = np.zeros(len(quote), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (a == ord(x)) & (b == ord(y))
        one = np.isin(a, [ord(x) for x in "stmd"])
        for hit, size in ((one, 1), (two & ~one, 2)):
            at = quote[hit]
            start[at + 1] = False
            start[at + 1 + size] = True
    return np.flatnonzero(start[:n])


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of stretches of the given sizes."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


class Encoder:
    """Encodes texts with a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        alphabet = byte_alphabet()
        self.symbol = np.array([vocab[c] for c in alphabet], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        key = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.keys, self.rank = key[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        back = {c: b for b, c in enumerate(alphabet)}
        size = 1 + max([*vocab.values(), *self.special.values()])
        raw = [b""] * size
        for word, i in vocab.items():
            raw[i] = bytes(back[c] for c in word)
        for word, i in self.special.items():
            raw[i] = word.encode()
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_len = np.array([len(x) for x in raw], np.int64)
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len
        self.known = np.zeros(0, U64)  # hashes of the words met before, sorted
        self.known_at = np.zeros(0, np.int64)
        self.known_len = np.zeros(0, np.int64)
        self.known_ids = np.zeros(0, np.int32)
        self.known_data = np.zeros(0, np.uint8)  # their bytes
        self.known_byte = np.zeros(0, np.int64)
        self.known_size = np.zeros(0, np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.rank[at], NO_RANK)

    def merge_words(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over the flat symbols of words of the given sizes."""
        n_words = len(size)
        word = np.repeat(np.arange(n_words), size)
        done_ids, done_word = [], []
        pair = np.full(len(sym), NO_RANK, np.int32)
        if len(sym) > 1:
            inside = word[1:] == word[:-1]
            pair[:-1][inside] = self.ranks(sym[:-1][inside], sym[1:][inside])
        while len(sym):
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(pair, begin)
            count = np.diff(np.append(begin, len(sym)))
            alive = np.repeat(best != NO_RANK, count)
            if not alive.all():
                done_ids.append(sym[~alive])
                done_word.append(word[~alive])
                sym, word, pair = sym[alive], word[alive], pair[alive]
                best, count = best[best != NO_RANK], count[best != NO_RANK]
                if not len(sym):
                    break
            hit = pair == np.repeat(best, count)
            at = np.flatnonzero(hit)
            # of overlapping equal pairs (aaa) every second one merges, from the left
            run = np.append(True, np.diff(at) != 1)
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            sym[at] = self.made[pair[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))  # positions after the deletion
            sym, word, pair = sym[keep], word[keep], pair[keep]
            fresh = np.concatenate([moved, moved[moved > 0] - 1])
            fresh_in = fresh[fresh + 1 < len(sym)]
            pair[fresh] = NO_RANK
            fresh = fresh_in[word[fresh_in] == word[fresh_in + 1]]
            pair[fresh] = self.ranks(sym[fresh], sym[fresh + 1])
        if not done_ids:
            return np.zeros(0, np.int32), np.zeros(n_words, np.int64)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_word)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=n_words)

    def merge_long(self, sym: np.ndarray) -> np.ndarray:
        """One long word: lowest rank first, leftmost among equals."""
        left = np.arange(-1, len(sym) - 1).tolist()
        right = [*range(1, len(sym)), -1]
        ranks = self.ranks(sym[:-1], sym[1:])
        at = np.flatnonzero(ranks != NO_RANK)
        sym = sym.tolist()
        heap = [(r, i, sym[i], sym[i + 1]) for r, i in zip(ranks[at].tolist(), at.tolist())]
        heapq.heapify(heap)
        table = self.table()
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = right[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j] = int(self.made[r]), -1
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (x := table.get((sym[i] << 32) | sym[k])) is not None:
                    heapq.heappush(heap, (x, i, sym[i], sym[k]))
            h = left[i]
            if h >= 0 and (x := table.get((sym[h] << 32) | sym[i])) is not None:
                heapq.heappush(heap, (x, h, sym[h], sym[i]))
        return np.array([x for x in sym if x >= 0], np.int32)

    def table(self) -> dict[int, int]:
        if not hasattr(self, "_table"):
            self._table = dict(zip(self.keys.tolist(), self.rank.tolist()))
        return self._table

    def encode_unique(self, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids and id counts of the words data[at : at + size]."""
        long = size > LONG_WORD
        short = np.flatnonzero(~long)
        inner = np.arange(size[short].sum()) - np.repeat(np.cumsum(size[short]) - size[short], size[short])
        ids, count = self.merge_words(self.symbol[data[np.repeat(at[short], size[short]) + inner]], size[short])
        if not long.any():
            return ids, count
        parts, counts = np.split(ids, np.cumsum(count)[:-1]), np.zeros(len(at), np.int64)
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(at)
        for i, x in zip(short, parts):
            out[i] = x
        for i in np.flatnonzero(long):
            out[i] = self.merge_long(self.symbol[data[at[i] : at[i] + size[i]]])
        counts[:] = [len(x) for x in out]
        return np.concatenate(out), counts

    def encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the ids' count of each text; no special tokens inside."""
        joined = "".join(texts)
        if not joined:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        cps = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        data = np.frombuffer(joined.encode(), np.uint8)
        lens = np.array([len(t) for t in texts])
        ends = np.cumsum(lens)
        start = word_starts(cps, (ends - lens)[lens > 0])
        if len(data) == len(cps):
            at = start
        else:
            width = 1 + (cps >= 0x80).astype(np.int8) + (cps >= 0x800) + (cps >= 0x10000)
            at = (np.cumsum(width, dtype=np.int64) - width)[start]
        size = np.diff(np.append(at, len(data)))
        bounds = np.append(at, len(data)).astype(np.int64)
        named = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        word = named.indices.to_numpy(zero_copy_only=False)
        u_at, u_len, ids = self.lookup(*text_bytes(named.dictionary))
        take, count = u_at[word], u_len[word]
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        flat = ids[np.repeat(take, count) + inner]
        bounds = np.append(0, np.cumsum(count))[np.searchsorted(start, np.append(0, ends))]
        return flat, np.diff(bounds)

    def lookup(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, count, ids) of distinct words, encoding the new ones.

        Known words are found by hash and compared by their bytes; a word whose
        hash another one has is encoded anew each time.
        """
        at, size = off[:-1], np.diff(off)
        with np.errstate(over="ignore"):
            code = mix(np.add.reduceat(byte_codes(11)[data] * powers(WORD_BASE, int(size.max()))[spread(np.zeros(len(at), np.int64), size)], at) + size.astype(U64))
        where = np.searchsorted(self.known, code)
        where[where == len(self.known)] = 0
        have = self.known[where] == code if len(self.known) else np.zeros(len(code), bool)
        have[have] = self.known_size[where[have]] == size[have]
        if have.any():
            own, other, some = at[have], self.known_byte[where[have]], size[have]
            equal = data[spread(own, some)] == self.known_data[spread(other, some)]
            have[have] = np.logical_and.reduceat(equal, np.cumsum(some) - some)
        new = np.flatnonzero(~have)
        ids, count = self.encode_unique(data, at[new], size[new]) if len(new) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        base = len(self.known_ids)
        all_ids = np.concatenate([self.known_ids, ids])
        u_at, u_len = np.empty(len(code), np.int64), np.empty(len(code), np.int64)
        u_at[have], u_len[have] = self.known_at[where[have]], self.known_len[where[have]]
        u_at[new], u_len[new] = base + np.cumsum(count) - count, count
        if len(self.known) + len(new) <= CACHED_WORDS and len(self.known_data) + size[new].sum() <= CACHED_BYTES:
            first = new[np.unique(code[new], return_index=True)[1]]  # one word a hash
            first = first[~np.isin(code[first], self.known)]
            byte = len(self.known_data) + np.cumsum(size[first]) - size[first]
            order = np.argsort(np.concatenate([self.known, code[first]]), kind="stable")
            for name, more in (("known", code), ("known_at", u_at), ("known_len", u_len), ("known_size", size)):
                setattr(self, name, np.concatenate([getattr(self, name), more[first]])[order])
            self.known_byte = np.concatenate([self.known_byte, byte])[order]
            self.known_data = np.concatenate([self.known_data, data[spread(at[first], size[first])]])
            self.known_ids = all_ids
        return u_at, u_len, all_ids

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text (null as empty)."""
        pieces: list[str] = []
        plan: list[list] = []  # of each text: piece numbers and special ids
        for t in texts:
            t, own = t or "", []
            cuts = [(t, None)]
            for word in self.special:
                if word in t:
                    cuts = [(x, None) if i == 0 else (x, word) for i, x in enumerate(t.split(word))]
            for x, word in cuts:
                if word is not None:
                    own.append((None, self.special[word]))
                own.append((len(pieces), None))
                pieces.append(x)
            plan.append(own)
        flat, chunk, size = [], [], 0
        for i, x in enumerate(pieces):
            chunk.append(x)
            size += len(x)
            if size >= CHUNK or i + 1 == len(pieces):
                ids, count = self.encode_plain(chunk)
                flat += np.split(ids, np.cumsum(count)[:-1])
                chunk, size = [], 0
        out = []
        for own in plan:
            if len(own) == 1:
                out.append(flat[own[0][0]])
            else:
                out.append(np.concatenate([flat[p] if p is not None else np.array([s], np.int32) for p, s in own]))
        return out

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        size = self.raw_len[ids]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return self.raw[np.repeat(self.raw_at[ids], size) + inner].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_column(path: str):
    """mapInArrow: a ``text`` column -> its rows with ``ids`` in its place."""

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            ids = enc.encode(batch.column("text").to_pylist())
            off = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
            col = pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]), pa.int32()))
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [col], names=[*names, "ids"])

    return run


def decode_column(path: str):
    """mapInArrow: an ``ids`` column -> its rows with ``text`` in its place."""

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            lists = batch.column("ids").to_pylist()
            text = pa.array([None if x is None else enc.decode(np.array(x, np.int64)) for x in lists], pa.string())
            names = [n for n in batch.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [text], names=[*names, "text"])

    return run


def bpe_encode(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, ids array<int>) of every text; a null text has no ids."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(encode_column(path), f"`{key}` {kind}, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, text) of every ids array; null ids give a null text."""
    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids").mapInArrow(decode_column(path), f"`{key}` {kind}, text string")


def id_digests(path: str):
    def run(batches):
        enc = encoder(path)
        words = [str(i) for i in range(len(enc.raw_len))]
        for batch in batches:
            n, a, b = [], [], []
            for ids in enc.encode(batch.column("text").to_pylist()):
                n.append(len(ids))
                a.append(hashlib.sha256(",".join([words[i] for i in ids.tolist()]).encode()).hexdigest())
                b.append(hashlib.sha256(enc.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    with arrow_settings(spark):
        return stage(docs.mapInArrow(id_digests(vocabulary()), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"), "op5")
