"""SentencePiece encoding and decoding: a batched Viterbi search in numpy.

Words of equal length advance together over their prefixes.  All substrings of
a length group are hashed at once and probe sorted piece keys; at each position
the pieces that may end the prefix there are weighed by a vectorised maximum,
and the chosen length is stored as the backpointer.

The model file at hand is a merge model (BPE with byte fallback): its scores
are ranks of merges, and the path of highest score sum is another one than the
library's.  What such a model fixes is which pieces may stand side by side: two
pieces do if the merges, applied to both texts joined, leave them apart.  The
encoding of a prefix is the one chain of pieces in which all neighbours may, so
its last piece is unique, and a piece extends a shorter prefix exactly if it may
follow that prefix's last piece.  ``PieceTable.apart`` decides this for
arrays of pairs by undoing the later merge of the two until a merge across the
cut would have come first (they join) or two characters are left (they don't).
Models of another type (unigram, word, character), user-defined pieces and
normalising models are refused with an error: this rule does not hold there.

A text becomes words by cutting before each run of word marks (U+2581); no
piece of such a model spans that cut, which ``PieceTable`` checks.  Encoded
words are kept in a bounded cache of the Python worker.  Words above
``LONG_WORD`` code points take the same steps one by one in Python, linear in
the word's length.  Substrings are told apart by 64-bit hashes: a false match has
a chance of some 1e-15 a probe and would show as a false ``round_trip``.

Defined cases: null text is empty and has no ids; characters outside the
vocabulary become byte pieces; texts with U+2581 decode to a blank there;
repeated rows are encoded alike; empty tables give no rows; other input
columns are not used.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.textops import whole

MARK = "▁"                    # fixed by the format: stands for a blank
LONG_WORD = 64
CACHE_WORDS = 200_000
CACHE_PAIRS = 500_000
PAIR_BITS = 20
MATRIX_ROWS = 8_192
_BASE = np.uint64(0x9E3779B97F4A7C15)      # odd multiplier of the rolling hash
_NO_MERGE = np.int64(1) << 40
_WORKER: dict = {}


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class PieceTable:
    """Arrays for encoding and decoding, made from the model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = pb.ModelProto()
        proto.ParseFromString(sp.serialized_model_proto())
        if proto.trainer_spec.model_type != pb.TrainerSpec.BPE:
            raise ValueError("only merge models (BPE) are encoded")
        if any(p.type == pb.ModelProto.SentencePiece.USER_DEFINED for p in proto.pieces):
            raise ValueError("user-defined pieces are not supported")
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("a model that normalises texts is not supported")
        n = sp.get_piece_size()
        plain = {sp.id_to_piece(i): i for i in range(n)
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        if any(MARK in p.lstrip(MARK) for p in plain):
            raise ValueError("a piece spans the cut between words")
        self.byte_id = np.zeros(256, np.int32)
        self.as_bytes = [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                b = int(sp.id_to_piece(i)[1:-1], 16)
                self.byte_id[b] = i
                self.as_bytes[i] = bytes([b])
        for p, i in plain.items():
            self.as_bytes[i] = p.replace(MARK, " ").encode()
        # symbols: pieces, then characters that only occur inside pieces
        ids = dict(plain)
        for c in sorted({c for p in plain for c in p} - set(plain)):
            ids[c] = len(ids) + n
        self.n_pieces = n
        chars = sorted(c for c in ids if len(c) == 1)
        self.char_code = np.array([ord(c) for c in chars], np.int64)
        self.char_id = np.array([ids[c] for c in chars], np.int64)
        self.inner_char = {ids[c]: ord(c) for c in chars if ids[c] >= n}
        pairs = sorted((ids[p[:k]] << 32 | ids[p[k:]], i) for p, i in plain.items()
                       for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids)
        self.pair_key = np.array([x[0] for x in pairs], np.int64)
        self.pair_id = np.array([x[1] for x in pairs], np.int64)
        # rank 0 is the first merge; characters are there before any, at -1
        scores = np.array([sp.get_score(i) for i in range(n)])
        self.rank = np.full(n + len(ids), -1, np.int64)
        merged = np.array(sorted(i for p, i in plain.items() if len(p) > 1), np.int64)
        self.rank[merged] = np.unique(-scores[merged], return_inverse=True)[1]
        # runs of word marks may share one rank, the last: they are joined after all else (``blanks``)
        values, times = np.unique(self.rank[merged], return_counts=True)
        tied = {p: i for p, i in plain.items() if len(p) > 1 and times[self.rank[i]] > 1}
        if (times[:-1] > 1).any() or any(p.strip(MARK) for p in tied):
            raise ValueError("two pieces share a score")
        if any(p.startswith(MARK * 2) and p not in tied for p in plain):
            raise ValueError("a piece starts with two word marks")
        self.mark = ids[MARK]
        self.runs = {1: self.mark, **{len(p): i for p, i in tied.items()}}
        whole_pieces = {p: i for p, i in plain.items() if p not in tied}
        keep = ~np.isin(self.pair_id, list(tied.values()))
        self.pair_key, self.pair_id = self.pair_key[keep], self.pair_id[keep]
        self._split(whole_pieces, ids)
        self._keys({p: i for p, i in whole_pieces.items() if len(p) > 1})
        self.ids = {p: i for p, i in ids.items() if p not in tied}
        self.pair_ok: dict = {}
        self.pairs_seen = np.full(1 << PAIR_BITS, -1, np.int64)

    def _split(self, plain: dict, ids: dict) -> None:
        """The two symbols that a piece's last merge joins; -1 for characters."""
        self.left = np.full(len(self.rank), -1, np.int64)
        self.right = self.left.copy()
        by_len: dict[int, list] = {}
        for p, i in plain.items():
            by_len.setdefault(len(p), []).append((p, i))
        for size in sorted(k for k in by_len if k > 1):
            cuts = np.array([(ids[p[:k]], ids[p[k:]], i) for p, i in by_len[size] for k in range(1, size)
                             if p[:k] in ids and p[k:] in ids], np.int64).reshape(-1, 3)
            made = ((self.rank[cuts[:, :2]] < 0) | (self.left[cuts[:, :2]] >= 0)).all(1)
            cuts = cuts[made & (self.rank[cuts[:, :2]] < self.rank[cuts[:, 2:]]).all(1)]
            cuts = cuts[self.apart(cuts[:, 0], cuts[:, 1], 2 * self.rank[cuts[:, 2]])]
            self.left[cuts[:, 2]], self.right[cuts[:, 2]] = cuts[:, 0], cuts[:, 1]
            if any(self.left[i] < 0 for _, i in by_len[size]):
                raise ValueError("a piece is no merge of earlier pieces")

    def may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``apart`` through a table of fixed size, in which a pair displaces another of its slot."""
        key = left << 32 | right
        slot = (key.astype(np.uint64) * _BASE >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        entry = self.pairs_seen[slot]
        ok = (entry & 1).astype(bool)
        miss = np.flatnonzero(entry >> 1 != key)
        if len(miss):
            ok[miss] = self.apart(left[miss], right[miss])
            good = miss[(left[miss] >= 0) & (right[miss] >= 0)]
            self.pairs_seen[slot[good]] = key[good] << 1 | ok[good]
        return ok

    def blanks(self, n: int) -> list[int]:
        """Ids of n word marks: equal merges, the one furthest left first."""
        out: list[int] = []
        for _ in range(n):
            out.append(1)
            while len(out) > 1 and out[-2] + out[-1] in self.runs:
                out[-2:] = [out[-2] + out[-1]]
        return [self.runs[k] for k in out]

    def _keys(self, pieces: dict) -> None:
        """Sorted hashes of the pieces of two code points and more."""
        self.longest = max(map(len, pieces), default=1)
        self.power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(self.longest, _BASE)]), dtype=np.uint64)
        groups: dict[int, list] = {}
        for p, i in pieces.items():
            groups.setdefault(len(p), []).append((p, i))
        self.piece_keys = {}
        for size, rows in groups.items():
            codes = np.frombuffer("".join(p for p, _ in rows).encode("utf-32-le"), "<u4").reshape(-1, size)
            key = self.prefix_hashes(codes)[:, -1]
            if len(np.unique(key)) < len(key):
                raise ValueError("two pieces share a hash")
            order = np.argsort(key)
            self.piece_keys[size] = key[order], np.array([i for _, i in rows], np.int64)[order]

    @staticmethod
    def prefix_hashes(codes: np.ndarray) -> np.ndarray:
        """Rolling hashes of all prefixes, modulo 2**64: (words, length + 1)."""
        x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(29)
        out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
        for k in range(codes.shape[1]):
            out[:, k + 1] = out[:, k] * _BASE + x[:, k]
        return out

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Ids of code points; those of no piece get ids below -1, which no pair has."""
        at = np.minimum(np.searchsorted(self.char_code, codes), len(self.char_code) - 1)
        return np.where(self.char_code[at] == codes, self.char_id[at], -2 - codes)

    def apart(self, left: np.ndarray, right: np.ndarray, limit=_NO_MERGE) -> np.ndarray:
        """Whether each pair of symbols stays two symbols when both texts are merged together.

        Times are twice the rank; of equal merges the one further left comes
        first, so a merge across the cut wins over an equal one inside ``right``.
        ``limit`` leaves out merges of that time and later."""
        ok = np.ones(len(left), bool)
        who = np.flatnonzero((left >= 0) & (right >= 0))
        a, b, limit = left[who], right[who], np.broadcast_to(limit, left.shape)[who]
        while len(who):
            key = a << 32 | b
            at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            join = (self.pair_key[at] == key) & (2 * self.rank[self.pair_id[at]] < limit)
            ok[who[join]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~join & ((ra >= 0) | (rb >= 0))
            who, a, b, ra, rb = who[go], a[go], b[go], ra[go], rb[go]
            first = ra > rb                     # the later merge is undone
            limit = np.where(first, 2 * ra, 2 * rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return ok

    def output(self, rows: np.ndarray) -> list[bytes]:
        """Little-endian ids of words that have equally many final symbols."""
        width = 4 * rows.shape[1]
        flat = rows.astype("<i4").tobytes()
        out = [flat[i:i + width] for i in range(0, len(flat), width)]
        odd = ((rows < 0) | (rows >= self.n_pieces)).any(1) | (rows[:, :2] == self.mark).all(1)
        for i in np.flatnonzero(odd):
            row = rows[i].tolist()
            marks = next((k for k, s in enumerate(row) if s != self.mark), len(row))
            ids = self.blanks(marks)
            for s in row[marks:]:
                if 0 <= s < self.n_pieces:
                    ids.append(s)
                else:                       # a character that is no piece: its bytes
                    ids += self.byte_id[list(chr(self.inner_char[s] if s >= 0 else -2 - s).encode())].tolist()
            out[i] = np.array(ids, "<i4").tobytes()
        return out

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words, batched by length."""
        by_len: dict[int, list[str]] = {}
        for w in words:
            by_len.setdefault(len(w), []).append(w)
        out = {}
        for n, group in by_len.items():
            if n > LONG_WORD:
                out.update((w, self.encode_long(w)) for w in group)
            else:
                for at in range(0, len(group), MATRIX_ROWS):
                    part = group[at:at + MATRIX_ROWS]
                    out.update(zip(part, self._encode_equal(part, n)))
        return out

    def _encode_equal(self, group: list[str], n: int) -> list[bytes]:
        """Viterbi over the prefixes of words of one length."""
        m, span = len(group), min(n, self.longest)
        codes = np.frombuffer("".join(group).encode("utf-32-le"), "<u4").reshape(m, n)
        hashes = self.prefix_hashes(codes)
        # ends[:, i, k]: the piece of k + 1 code points that ends at position i, -1 for none
        ends = np.full((m, n + 1, span), -1, np.int64)
        ends[:, 1:, 0] = self.symbols(codes.astype(np.int64))
        for size, (key, ids) in self.piece_keys.items():
            if size <= span:
                sub = hashes[:, size:] - hashes[:, :-size] * self.power[size]
                at = np.minimum(np.searchsorted(key, sub), len(key) - 1)
                ends[:, size:, size - 1] = np.where(key[at] == sub, ids[at], -1)
        last = np.full((m, n + 1), -1, np.int64)
        back = np.zeros((m, n + 1), np.int64)
        row = np.arange(m)
        for i in range(1, n + 1):
            reach = min(i, span)
            piece = ends[:, i, :reach]
            start = i - np.arange(1, reach + 1)
            may = piece != -1
            open_ = may & (may.sum(1) > 1)[:, None] & (start > 0)       # a lone candidate is the one
            r, k = np.divmod(np.flatnonzero(open_), reach)
            may[r, k] = self.may_follow(last[r, i - 1 - k], piece[r, k])
            if not may.any(1).all():
                raise ValueError("a prefix has no encoding")
            length = reach - may[:, ::-1].argmax(1)
            back[:, i] = length
            last[:, i] = piece[row, length - 1]
        return self._trace(last, back, n)

    def _trace(self, last: np.ndarray, back: np.ndarray, n: int) -> list[bytes]:
        """Ids along the backpointers; words of equally many pieces are written together."""
        m = len(last)
        path, at = np.full((m, n), -1, np.int64), np.full(m, n)
        count = np.zeros(m, np.int64)
        while (live := np.flatnonzero(at > 0)).size:
            step = back[live, at[live]]
            path[live, n - 1 - count[live]] = last[live, at[live]]
            at[live] -= step
            count[live] += 1
        out: list = [b""] * m
        for c in np.unique(count):
            rows = np.flatnonzero(count == c)
            for i, ids in zip(rows, self.output(path[rows, n - c:])):
                out[i] = ids
        return out

    def _apart_one(self, left: int, right: int) -> bool:
        """``apart`` for one pair, remembered in a bounded table."""
        key = left << 32 | right
        if left < 0 or right < 0:
            return True
        known = self.pair_ok.get(key)
        if known is None:
            if len(self.pair_ok) >= CACHE_PAIRS:
                self.pair_ok.clear()
            known = self.pair_ok[key] = bool(self.apart(np.array([left]), np.array([right]))[0])
        return known

    def encode_long(self, word: str) -> bytes:
        """The same search, one position at a time: for words too long for a matrix."""
        chars = self.symbols(np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.int64)).tolist()
        last, back, get = [-1], [0], self.ids.get
        for i in range(1, len(word) + 1):
            for k in range(min(i, self.longest), 0, -1):
                piece = chars[i - 1] if k == 1 else get(word[i - k:i], -1)
                if piece != -1 and (i == k or back[i - k] and self._apart_one(last[i - k], piece)):
                    last.append(piece)
                    back.append(k)
                    break
            else:
                raise ValueError("a prefix has no encoding")
        path, i = [], len(word)
        while i:
            path.append(last[i])
            i -= back[i]
        return self.output(np.array([path[::-1]], np.int64))[0]

    def decode(self, ids) -> str:
        text = b"".join(map(self.as_bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def _worker_state(path: str) -> list:
    if path not in _WORKER:
        _WORKER[path] = [PieceTable(path), {}]
    return _WORKER[path]


_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def encode_texts(texts: list[str], table: PieceTable, cache: dict) -> list[bytes]:
    """Little-endian int32 ids of each text."""
    cut = [_WORDS.findall((MARK + t).replace(" ", MARK)) if t else [] for t in texts]
    missing = {w for ws in cut for w in ws if w not in cache}
    if missing:
        cache.update(table.encode_words(sorted(missing)))
    return [b"".join(map(cache.__getitem__, ws)) for ws in cut]


def encode(docs: DataFrame, text: str = "text", path: str | None = None, batch: int = 512) -> DataFrame:
    """(doc_id, n_tokens, ids array<int>, round_trip): ids of every whole text, and whether they decode to it."""
    path = path or default_path()
    t = docs.select("doc_id", whole(text).alias("t"))
    id_field = t.schema["doc_id"]

    def run(batches):
        state = _worker_state(path)
        table = state[0]
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                texts = part.column(1).to_pylist()
                if len(state[1]) > CACHE_WORDS:
                    state[1] = {}
                coded = encode_texts(texts, table, state[1])
                flat = np.frombuffer(b"".join(coded), "<i4")
                ends = np.cumsum([0, *(len(x) // 4 for x in coded)])
                back = [table.decode(flat[i:j].tolist()) == x for i, j, x in zip(ends, ends[1:], texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(ends), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                     pa.array(back, pa.bool_())], ["doc_id", "n_tokens", "ids", "round_trip"])
    return t.mapInArrow(run, f"doc_id {id_field.dataType.simpleString()}, n_tokens bigint, ids array<int>, round_trip boolean")


def decode(coded: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """(doc_id, text) from ids; null ids give empty text."""
    path = path or default_path()

    @F.pandas_udf("string")
    def back(s):
        table = _worker_state(path)[0]
        return s.map(lambda x: "" if x is None else table.decode(x))
    return coded.select("doc_id", back(F.col(ids)).alias("text"))
