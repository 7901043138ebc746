"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The vocabulary comes from the model file; the merging is done here. A text is normalised as the model says
(identity; a leading space is added to a text that is not empty; U+0020 becomes U+2581) and cut before each
run of spaces: no piece holds a space mark after another character, so no merge crosses such a cut. Distinct
units of a batch are encoded together, in flat numpy arrays of symbols:

* every round looks up the rank of each adjacent pair and takes the smallest rank of each unit;
* the pairs of that rank merge, the leftmost first and none overlapping, in all units at once, and the arrays
  are compacted. Where the merged piece could start a pair of the same or a smaller rank, only the unit's
  leftmost one merges in this round, as the sequential algorithm would;
* long units are cut, from round to round, between neighbours that no piece holds side by side: whatever
  spans such a place would hold both of them whole, so no merge ever crosses it. Each part then goes by its own
  smallest rank, and a text without spaces needs few rounds too;
* units without a pair leave. Characters that are no pieces are bytes from the start, which merge with nothing.

Models that normalise texts otherwise, or are no BPE models, are refused: probes must encode as the library does.

Null and empty texts have the end id only. Characters outside the vocabulary decode from their bytes. Null
ids, repeated rows and ties (equal ranks: the leftmost pair first) need no special case. Very long texts are
encoded in slices, cut before a space; only what stands between two spaces is held at once. Columns of any
names may stand beside the two that are read, and are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemill.llm.workers import lean

SPACE_MARK = "▁"
#: Units whose encodings a worker keeps, at most, their length, at most, and bytes of text that it encodes at once, about.
KEPT_UNITS, KEPT_LENGTH, CHUNK_BYTES = 80_000, 32, 1 << 19
#: Units of so many symbols are cut between neighbours that no piece holds, every so many rounds.
LONG_UNIT, CUT_ROUNDS = 64, 8
#: Texts whose encoding shows a normaliser, prefix or segmentation that this module does not implement.
PROBES = ["a", " a", "a  b ", "Ａﬁ①", "é e\u0301", "x\ty\nz", "\u00a0\u3000.", "the quick brown fox jumps", "internationalisation", "日本語 \U0001f600", "aaaaaaa bbbb"]
_NONE = np.iinfo(np.int64).max
_UNIT = re.compile(" +[^ ]*")
_GAP = re.compile("(?<=[^ ▁])[ ▁]")


class PairTable:
    """Merged piece of a pair of symbols, found by hash for many pairs at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int = 19):
        self.shift = np.uint64(64 - bits)
        order = np.argsort(self._slot(keys), kind="stable")
        slot = self._slot(keys)[order]
        start = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, np.int64)
        turn = np.arange(len(slot)) - np.repeat(start, np.diff(np.append(start, len(slot))))
        self.keys = np.full((int(turn.max(initial=0)) + 1, 1 << bits), -1)
        self.values = np.full(self.keys.shape, -1, np.int32)
        self.keys[turn, slot], self.values[turn, slot] = keys[order], values[order]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        slot = self._slot(keys)
        found = self.keys[0][slot]
        out = np.where(found == keys, self.values[0][slot], -1)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        for k in range(1, len(self.keys)):
            if not len(open_):
                break
            at, key = slot[open_], keys[open_]
            found = self.keys[k][at]
            hit = found == key
            out[open_[hit]] = self.values[k][at[hit]]
            open_ = open_[~hit & (found >= 0)]
        return out


class BpeCodec:
    """Encoder and decoder of one model file; `path` can be read on every executor."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        self.eos = sp.eos_id()
        self.byte_ids = np.zeros(256, np.int64)
        self.bytes_of: list[bytes] = []
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                self.byte_ids[int(p[1:-1], 16)] = i
                self.bytes_of.append(bytes([int(p[1:-1], 16)]))
            else:
                self.bytes_of.append(b"" if sp.is_control(i) else p.replace(SPACE_MARK, " ").encode())
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.ids = {p: i for i, p in enumerate(pieces) if plain[i]}
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.ids):
            raise ValueError("a piece holds a space mark after another character")
        if any(c not in self.ids for p in self.ids for c in p):
            raise ValueError("a piece holds a character that is no piece")
        # characters to symbols: pieces, bytes of ASCII characters that are none, or -1 for more than one byte
        self.first = np.full(0x110000, -1, np.int32)
        self.first[:0x80] = self.byte_ids[:0x80]
        for p, i in self.ids.items():
            if len(p) == 1:
                self.first[ord(p)] = i
        # a smaller rank merges first; equal scores share a rank and the leftmost pair wins
        scores = np.array([-sp.get_score(i) for i in range(n)])
        self.rank = np.unique(scores, return_inverse=True)[1].astype(np.int64)
        left, right, made = [], [], []
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                a, b = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(i)
        made_ids = np.array(made, np.int64)
        self.n, self.pairs = n, PairTable(np.array(left, np.int64) * n + np.array(right, np.int64), made_ids)
        # the smallest rank of any pair that has this symbol on a side
        best = np.full(n, _NONE)
        np.minimum.at(best, left, self.rank[made_ids])
        np.minimum.at(best, right, self.rank[made_ids])
        self.safe = best > self.rank
        # each id's decimal digits with a space after them, and its bytes
        self.digits = Ragged([b"%d " % i for i in range(n)])
        self.text = Ragged(self.bytes_of)
        self._beside: np.ndarray | None = None
        if any(self.encode(t) != [*sp.encode(t), self.eos] for t in PROBES):
            raise ValueError(f"{path} is no BPE model with a dummy prefix, identity normalisation and bytes for unknown characters")

    def beside(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether some piece holds the two symbols side by side. The table is made when first asked for."""
        if self._beside is None:
            keys = array("q")
            for p in self.ids:
                for k in range(1, len(p)):
                    before = [a for i in range(k) if (a := self.ids.get(p[i:k])) is not None]
                    after = [b for j in range(k + 1, len(p) + 1) if (b := self.ids.get(p[k:j])) is not None]
                    keys.extend(a * self.n + b for a in before for b in after)
            self._beside = np.unique(np.frombuffer(keys, np.int64)) if keys else np.zeros(1, np.int64)
        key = left * self.n + right
        return self._beside[np.minimum(np.searchsorted(self._beside, key), len(self._beside) - 1)] == key

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of normalised units (space marks written as spaces), one after the other, and the units' limits in them."""
        text = "".join(units).replace(" ", SPACE_MARK)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        unit = np.repeat(np.arange(len(units)), np.fromiter(map(len, units), np.int64, len(units)))
        symbols = self.first[codes].astype(np.int64)
        odd = np.flatnonzero(symbols < 0)
        if len(odd):  # one symbol a byte; those merge with nothing
            spelled = [self.byte_ids[list(chr(codes[i]).encode())] for i in odd]
            size = np.ones(len(symbols), np.int64)
            size[odd] = [len(x) for x in spelled]
            unit = np.repeat(unit, size)
            start = np.cumsum(size) - size
            symbols = np.repeat(symbols, size)
            symbols[np.repeat(start[odd], size[odd]) + np.concatenate([np.arange(len(x)) for x in spelled])] = np.concatenate(spelled)
        # parts of units that merge on their own, and each symbol's place; merged ones keep that of their left end
        part, place = unit.astype(np.int32), np.arange(len(symbols), dtype=np.int32)
        all_units, total = unit, len(symbols)
        done_symbols, done_places, turn = [], [], 0
        while len(symbols):
            last = np.append(part[1:] != part[:-1], True)
            if turn % CUT_ROUNDS == 0:
                begin = np.flatnonzero(np.append(True, last[:-1]))
                count = np.diff(np.append(begin, len(symbols)))
                if count.max() >= LONG_UNIT:
                    long_ = np.flatnonzero(np.repeat(count >= LONG_UNIT, count) & ~last)
                    last[long_[~self.beside(symbols[long_], symbols[long_ + 1])]] = True
                    part = np.cumsum(last, dtype=np.int32) - last
            turn += 1
            made = self.pairs.find(symbols * self.n + np.append(symbols[1:], 0))
            made[last] = -1
            rank = np.where(made >= 0, self.rank[made], _NONE)
            begin = np.flatnonzero(np.append(True, last[:-1]))
            least = np.minimum.reduceat(rank, begin)
            count = np.diff(np.append(begin, len(symbols)))
            going = least < _NONE
            if not going.all():
                active = np.repeat(going, count)
                done_symbols.append(symbols[~active]), done_places.append(place[~active])
                symbols, part, place, rank, made = symbols[active], part[active], place[active], rank[active], made[active]
                least, count = least[going], count[going]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(least, count))
            # of overlapping places, which are neighbours, every second one from the left merges
            new = np.append(True, (at[1:] != at[:-1] + 1) | (part[at[1:]] != part[at[:-1]]))
            run = np.flatnonzero(new)
            offset = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            # where the merged piece is not safe, only the part's first place
            take, unsafe = offset % 2 == 0, ~self.safe[made[at]]
            if unsafe.any():
                first = np.append(True, part[at[1:]] != part[at[:-1]])
                careful = np.logical_or.reduceat(unsafe, np.flatnonzero(first))
                take = np.where(careful[np.cumsum(first) - 1], first, take)
            at = at[take]
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, part, place = symbols[keep], part[keep], place[keep]
        out = np.full(total, -1, np.int32)
        for k, v in zip([*done_places, place], [*done_symbols, symbols], strict=True):
            out[k] = v
        kept = out >= 0
        return out[kept], np.append(0, np.cumsum(np.bincount(all_units[kept], minlength=len(units))))

    @staticmethod
    def units(text: str) -> list[str]:
        """Normalised text, cut before each run of spaces."""
        if not text:
            return []
        text = " " + text.replace(SPACE_MARK, " ")
        return _UNIT.findall(text)

    def encode(self, text: str) -> list[int]:
        return [*self.encode_units(self.units(text))[0].tolist(), self.eos]

    def decode(self, ids) -> str:
        """Text of ids: pieces joined, bytes read as UTF-8 (each byte that is none: U+FFFD), the leading space dropped."""
        out, pending, begun = [], b"", False
        for i in ids:
            if self.is_byte[i]:
                pending += self.bytes_of[i]
                continue
            if pending:
                out.append(_utf8(pending))
                begun, pending = True, b""
            piece = self.bytes_of[i].decode()
            if piece and not begun:
                piece, begun = piece.removeprefix(" "), True
            out.append(piece)
        return "".join(out) + _utf8(pending)


def _utf8(data: bytes) -> str:
    """UTF-8, with one U+FFFD for each byte that belongs to no character."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(data):
            for n in (1, 2, 3, 4):
                try:
                    out.append(data[i : i + n].decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


_CODECS: dict[str, BpeCodec] = {}


def codec(path: str) -> BpeCodec:
    if path not in _CODECS:
        _CODECS[path] = BpeCodec(path)
    return _CODECS[path]


class Ragged:
    """Byte strings by number, for gathering many at once."""

    def __init__(self, values: list[bytes]):
        self.size = np.array([len(v) for v in values], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(values), np.uint8)

    def take(self, numbers: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strings of numbers, one after the other, and the limits of rows (limits in numbers) in them."""
        size = self.size[numbers]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[numbers] - ends[:-1], size) + np.arange(ends[-1])
        return self.data[at], ends[rows]


def _occurrences(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Units of texts, and the texts' limits in them. A unit is written without its (last) space.

    Where no two spaces meet, units are what stands between spaces; the other texts are cut by a pattern.
    """
    meets = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, SPACE_MARK))
    meets = pc.or_(meets, pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))
    plain = pc.split_pattern(pc.if_else(meets, "", texts), " ")
    if not pc.any(meets).as_py() and not pc.any(pc.equal(texts, "")).as_py():
        return plain.flatten(), plain.offsets.to_numpy()
    lists = plain.to_pylist()
    for i in np.flatnonzero(pc.or_(meets, pc.equal(texts, "")).to_numpy(zero_copy_only=False)):
        lists[i] = [u[1:] for u in BpeCodec.units(texts[int(i)].as_py())]
    return pa.array([u for us in lists for u in us], pa.string()), np.cumsum([0, *map(len, lists)])


class Encoder:
    """Encodes texts of a worker one after the other; keeps the ids of short units that it has met."""

    def __init__(self, c: BpeCodec):
        self.c, self.seen = c, {}

    def ids_of(self, names: list[str]) -> list[bytes]:
        """The ids (int32) of each of these distinct units, written without their last space."""
        new = [u for u in names if u not in self.seen]
        ids, limits = self.c.encode_units([" " + u for u in new])
        data, at = ids.tobytes(), (limits * 4).tolist()
        fresh = {u: data[a:b] for u, a, b in zip(new, at, at[1:], strict=False)}
        out = [self.seen.get(u) or fresh[u] for u in names]
        if len(self.seen) + len(fresh) > KEPT_UNITS:
            self.seen.clear()
        if len(fresh) <= KEPT_UNITS:
            self.seen.update((u, b) for u, b in fresh.items() if len(u) <= KEPT_LENGTH)
        return out

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, each with the end id, and the texts' limits in them."""
        return self.units(*_occurrences(texts))

    def units(self, flat: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As texts, of texts that are cut into units already."""
        coded = flat.dictionary_encode()
        parts = self.ids_of(coded.dictionary.to_pylist())
        unit_ids = np.frombuffer(b"".join(parts), np.int32)
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        start = np.cumsum(size) - size
        which = coded.indices.to_numpy(zero_copy_only=False)
        # places of the texts' ids, with one more for the end of each text
        length = size[which]
        ends = np.concatenate([[0], np.cumsum(length)])
        out_rows = ends[rows] + np.arange(len(rows))
        at = np.repeat(start[which] - ends[:-1], length) + np.arange(ends[-1])
        out = np.full(out_rows[-1], self.c.eos, np.int32)
        body = np.ones(len(out), bool)
        body[out_rows[1:] - 1] = False
        out[body] = unit_ids[at]
        return out, out_rows

    def long_text(self, text: str) -> Iterator[np.ndarray]:
        """Ids of one long text in parts, the end id last."""
        for low, high in slices(text):
            units = _UNIT.findall((" " if low == 0 else "") + text[low:high].replace(SPACE_MARK, " "))
            ids, _ = self.units(pa.array([u[1:] for u in units], pa.string()), np.array([0, len(units)]))
            yield ids if high == len(text) else ids[:-1]

    def digested(self, texts: pa.Array, with_ids: bool) -> tuple[list, list, list, list]:
        """Of each text: the number of ids, the digest of their digits, the decoded text, and the ids if asked for."""
        ids, rows = self.texts(texts)
        digits, ends = self.c.digits.take(ids, rows)
        digits = digits.tobytes()
        shas = [hashlib.sha256(digits[a : b - 1]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        spelled, ends = self.c.text.take(ids, rows)
        spelled = spelled.tobytes()
        back = [spelled[a + (spelled[a : a + 1] == b" ") : b].decode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return np.diff(rows).tolist(), shas, back, [ids[a:b] for a, b in zip(rows[:-1], rows[1:], strict=True)] if with_ids else []

    def digested_long(self, text: str, with_ids: bool) -> tuple[list, list, list, list]:
        """As digested, of one long text, part by part."""
        n, sha, back, every, tail = 0, hashlib.sha256(), [], [], b""
        for ids in self.long_text(text):
            limits = np.array([0, len(ids)])
            digits = tail + self.c.digits.take(ids, limits)[0].tobytes()
            sha.update(digits[:-1])
            tail = b" "  # between two parts
            back.append(self.c.text.take(ids, limits)[0].tobytes())
            n += len(ids)
            if with_ids:
                every.append(ids)
        spelled = b"".join(back)
        return [n], [sha.hexdigest()], [spelled[spelled[:1] == b" " :].decode()], [np.concatenate(every)] if with_ids else []


def slices(text: str) -> Iterator[tuple[int, int]]:
    """Limits of slices of a text of CHUNK_BYTES characters or more, each but the first from a run of spaces on."""
    low = 0
    while low < len(text):
        cut = _GAP.search(text, low + CHUNK_BYTES)
        high = cut.start() if cut else len(text)
        yield low, high
        low = high


def _encoded(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(codec(path))
        for batch in batches:
            texts = batch.column("text")
            each = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            size = np.cumsum(each)
            at = 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + CHUNK_BYTES, "right")))
                if each[at] > 2 * CHUNK_BYTES:
                    got = encoder.digested_long(texts[at].as_py(), with_ids)
                else:
                    got = encoder.digested(texts.slice(at, to - at), with_ids)
                kinds = [pa.int64(), pa.string(), pa.string(), *[pa.list_(pa.int32())] * with_ids]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, to - at), *(pa.array(v, k) for v, k in zip(got, kinds, strict=False))], ["id", "n_tokens", "ids_sha256", "decoded", *["ids"] * with_ids])
                at = to

    return lean(run)


def encode_documents(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per input row: the id, n_tokens long, ids_sha256, decoded string and, if asked for, ids array<int>."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = "id long, n_tokens long, ids_sha256 string, decoded string" + (", ids array<int>" if with_ids else "")
    return docs.mapInArrow(_encoded(model_path, with_ids), schema).withColumnRenamed("id", id_col)


def digests(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    out = encode_documents(df, model_path, id_col, text_col)
    return out.select(id_col, "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
