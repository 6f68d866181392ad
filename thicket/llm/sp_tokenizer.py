"""SentencePiece encoding and decoding on the tokenizers library, rebuilt from the model file's protobuf."""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import arrow_schema, give_back, map_rows

MARK = "▁"
#: Fixed values of the model format: piece kinds, model kinds, and field numbers.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Bounds on memory alone: characters of a batch (a longer text goes alone), new words handed to the library at once, bytes of remembered words.
BATCH_CHARS, FRESH_WORDS, MEMO_BYTES = 1 << 18, 10_000, 40 << 20
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def wire(buffer: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of one protobuf message: integers, 4 or 8 raw bytes, or a byte string."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = buffer[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(buffer):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"wire type {kind} in a model file")
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, buffer[at : at + size]
        at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, kind
    kind: int = UNIGRAM
    unk_id: int = 0
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    suffix: bool = False


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in wire(data):
        if number == 1:
            part = dict(wire(value))
            model.pieces.append((part.get(1, b"").decode(), struct.unpack("<f", part[2])[0] if 2 in part else 0.0, part.get(3, NORMAL)))
        elif number == 2:
            part = dict(wire(value))
            model.kind, model.byte_fallback, model.suffix = part.get(3, UNIGRAM), bool(part.get(35, 0)), bool(part.get(24, 0))
        elif number == 3:
            part = dict(wire(value))
            model.charsmap = part.get(2, b"")
            model.dummy_prefix, model.squeeze, model.escape = bool(part.get(3, 1)), bool(part.get(4, 1)), bool(part.get(5, 1))
    model.unk_id = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), 0)
    if model.kind not in (UNIGRAM, BPE) or model.suffix or not model.escape:
        raise ValueError("only unigram and BPE models with the marker before words are supported")
    return model


class Codec:
    """Encodes and decodes like the SentencePiece library does with the same model."""

    def __init__(self, data: bytes, threads: int = 2):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        from tokenizers import Regex, Tokenizer, models, normalizers

        self.model = m = parse_model(data)
        # Control and unknown pieces never match text, nor byte and user pieces in a unigram model: they go by names with a space, which normalised text has not.
        plain = {p[0]: i for i, p in enumerate(m.pieces) if p[2] in (NORMAL, USER)}
        self.bytes_of = {int(t[3:5], 16): i for i, (t, _, k) in enumerate(m.pieces) if k == BYTE} if m.byte_fallback else {}
        if m.kind == UNIGRAM:
            high = max((p[1] for p in m.pieces if p[2] == NORMAL), default=0.0)
            vocab = [(t, s) if k == NORMAL else (f" {i}", high) for i, (t, s, k) in enumerate(m.pieces)]
            core = models.Unigram(vocab, m.unk_id, False)
        else:
            merges = []
            normal = {t for t, i in plain.items() if m.pieces[i][2] == NORMAL}
            for text in normal:
                i = plain[text]
                for k in range(1, len(text)):
                    left, right = text[:k], text[k:]
                    if left in normal and right in normal:
                        merges.append((-m.pieces[i][1], i, k, left, right))
            merges.sort()
            named = {t if k in (NORMAL, USER, BYTE) else f" {i}": i for i, (t, _, k) in enumerate(m.pieces)}
            core = models.BPE(named, [(a, b) for _, _, _, a, b in merges], unk_token=f" {m.unk_id}", fuse_unk=True, byte_fallback=m.byte_fallback)
        self.tokenizer = Tokenizer(core)
        self.charsmap = normalizers.Precompiled(m.charsmap) if m.charsmap else None
        self.squeeze = normalizers.Sequence([normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]) if m.squeeze else None
        # User pieces stand as they are written: no normalisation changes them, they are matched first and nothing joins with them.
        users = sorted((t for t, i in plain.items() if m.pieces[i][2] == USER), key=lambda t: (-len(t), t))
        self.users = re.compile("(" + "|".join(map(re.escape, users)) + ")") if users else None
        self.whole = {t: struct.pack("<i", plain[t]) for t in users}
        # Where no piece has the marker after another character, no piece crosses from a word into the markers that follow: words,
        # each with its markers, can be encoded apart, and a repeated one once.
        self.splits = not any(MARK in t.lstrip(MARK) for t in plain)
        self.memo: dict[str, bytes] = {}
        self.memo_bytes = 0
        shown = {UNKNOWN: " ⁇ ".encode(), CONTROL: b""}
        self.raw = [bytes([int(t[3:5], 16)]) if k == BYTE else shown.get(k, t.replace(MARK, " ").encode()) for t, _, k in m.pieces]

    def normal(self, text: str) -> str:
        if self.charsmap and self.users:
            text = "".join(part if i % 2 else self.charsmap.normalize_str(part) for i, part in enumerate(self.users.split(text)))
        elif self.charsmap:
            text = self.charsmap.normalize_str(text)
        if self.squeeze:
            text = self.squeeze.normalize_str(text)
        return (MARK if self.model.dummy_prefix and text else "") + text.replace(" ", MARK)

    def _parts(self, text: str) -> list[str]:
        """What is encoded apart: user pieces, words where pieces stay inside them, else what is between user pieces."""
        pieces = self.users.split(text) if self.users else [text]
        if not self.splits:
            return [x for x in pieces if x]
        return [w for i, x in enumerate(pieces) for w in ([x] if i % 2 else _WORD.findall(x))]

    def _encoded(self, words: list[str]) -> list[bytes]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        unknown = self.model.unk_id
        if self.bytes_of and self.model.kind == UNIGRAM and (odd := [k for k, x in enumerate(ids) if unknown in x]):
            for k, e in zip(odd, self.tokenizer.encode_batch([words[k] for k in odd], add_special_tokens=False), strict=True):
                ids[k] = [j for i, t in zip(e.ids, e.tokens, strict=True) for j in (map(self.bytes_of.__getitem__, t.encode()) if i == unknown else (i,))]
        return [struct.pack(f"<{len(x)}i", *x) for x in ids]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as 32-bit little-endian integers. Words are remembered, in MEMO_BYTES at most; nothing else stays."""
        split = [self._parts(self.normal(t)) for t in texts]
        memo = self.memo
        if self.memo_bytes > MEMO_BYTES:
            memo.clear()
            self.memo_bytes = 0
        memo.update(self.whole)
        fresh = list({w for words in split for w in words}.difference(memo))
        for lo in range(0, len(fresh), FRESH_WORDS):
            part = fresh[lo : lo + FRESH_WORDS]
            memo.update(zip(part, self._encoded(part), strict=True))
        ids = [b"".join(map(memo.__getitem__, words)) for words in split]
        if not self.model.byte_fallback:  # a run of unknown pieces is one, across words too
            ids = [self._once(x) for x in ids]
        for w in fresh:
            if len(w) > 32:
                del memo[w]  # long ones hardly come back
        self.memo_bytes += 190 * len(fresh)  # of a short word, its ids and their place
        return ids

    def _once(self, ids: bytes) -> bytes:
        found = np.frombuffer(ids, "<i4")
        return found[~((found == self.model.unk_id) & np.r_[False, found[:-1] == self.model.unk_id])].tobytes() if len(found) else ids

    def decode(self, ids: bytes | list[int]) -> str:
        ids = np.frombuffer(ids, "<i4").tolist() if isinstance(ids, bytes) else ids
        if ids and not (0 <= min(ids) and max(ids) < len(self.raw)):
            raise ValueError("an id outside the vocabulary")
        parts = list(map(self.raw.__getitem__, ids))
        if self.model.dummy_prefix or self.model.squeeze:
            for k, i in enumerate(ids):  # the marker put before the text goes; where spaces are squeezed, so do markers right after it
                if self.model.pieces[i][2] in (NORMAL, USER) and parts[k].startswith(b" "):
                    parts[k] = parts[k][1:]
                    if self.model.squeeze and not parts[k]:
                        continue
                break
        return b"".join(parts).decode("utf-8", "replace")


_codecs: dict[tuple[bytes, int], Codec] = {}


def codec_for(data: bytes, threads: int) -> Codec:
    """One codec a model and worker process, held against the SentencePiece library on the probe texts when it is made."""
    key = (hashlib.sha256(data).digest(), threads)
    if key not in _codecs:
        _codecs.clear()
        made = Codec(data, threads)
        if bad := unequal(made, data, PROBES):
            raise ValueError(f"parity with the SentencePiece library is lost on {bad!r}")
        made.memo.clear()
        _codecs[key] = made
        give_back()
    return _codecs[key]


#: Texts on which a task's codec is held against the SentencePiece library before it encodes anything.
PROBES = ["", " ", "a", "  two  spaces ", "Über naïve façades, 12.5 %!", "tabs\tand\nlines\r\n", "你好 \U0001f600‍", "ALL!! CAPS$$$ ###", "x" * 300, "▁ marker", "<s> </s> <unk> <0x41>"]


def unequal(codec: Codec, data: bytes, texts: list[str]) -> list[str]:
    """Those of `texts` that the SentencePiece library encodes otherwise; the marker itself is left out, which only the library folds to a space twice."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_proto=data)
    return [t for t, a, b in zip(texts, codec.encode_batch(texts), own.encode(texts, num_threads=1), strict=True) if np.frombuffer(a, "<i4").tolist() != b]


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", threads: int | None = None) -> DataFrame:
    """docs -> (doc_id, n_tokens, ids, ids_sha256, round_trip), one row per row of `docs`.

    ids: the piece ids of the whole text, without begin and end pieces. ids_sha256: of the ids as 32-bit little-endian integers. round_trip: decoding the ids
    gives the text again (false where the model's normaliser changes it). Null text: null ids, digest and round_trip, 0 tokens; empty text: no ids.
    Equal rows come out alike, each with a row. Empty table: no rows. Other columns are not read, whatever their names. Lone surrogates count as
    the replacement character. A very long text goes to the library alone, word by word where the model's pieces allow it.

    The model travels to the tasks as a broadcast of the file's bytes, some hundred KB. A worker process makes one codec and refuses to use it where it
    differs from the SentencePiece library on the probe texts. Batches, remembered words and output are bounded in bytes. threads: of the
    library in a worker; by default the CPUs of a task, 2 at least.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    threads = threads or max(2, int(spark.conf.get("spark.task.cpus", "1")))
    out_type = StructType.fromDDL("doc_id bigint, n_tokens bigint, ids array<int>, ids_sha256 string, round_trip boolean")
    schema = arrow_schema(out_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(shared.value, threads)

        def encoded(keys: list[int | None], texts: list[str | None]) -> pa.RecordBatch:
            given = [(t or "").encode("utf-8", "replace").decode() for t in texts]
            ids = codec.encode_batch(given)
            null = np.array([t is None for t in texts])
            edges = pa.array(np.r_[0, np.cumsum([len(i) // 4 for i in ids])].astype(np.int32), mask=np.r_[null, False])
            lists = pa.ListArray.from_arrays(edges, pa.array(np.frombuffer(b"".join(ids), "<i4")))
            return pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()), lists.cast(schema.field("ids").type),
                pa.array([None if t is None else hashlib.sha256(i).hexdigest() for t, i in zip(texts, ids, strict=True)], pa.string()),
                pa.array([None if t is None else codec.decode(i) == g for t, g, i in zip(texts, given, ids, strict=True)], pa.bool_()),
            ], schema=schema)

        keys, texts, size, since = [], [], 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                keys.append(batch.column(0)[i].as_py())
                texts.append(text)
                size += len(text or "") + 1
                if size >= BATCH_CHARS:
                    yield encoded(keys, texts)
                    since += size
                    keys, texts, size = [], [], 0
                    if since >= 32 * BATCH_CHARS:
                        give_back()
                        since = 0
        if keys:
            yield encoded(keys, texts)
        give_back()

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, out_type)


def decode(encoded: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids) -> (doc_id, text). Null ids: null text. Ids outside the vocabulary, negative ones too, fail the task."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def make():
        codec = codec_for(shared.value, 2)

        def one(doc_id, ids):
            yield doc_id, None if ids is None else codec.decode(ids)

        return one

    return map_rows(encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).alias("ids")), make, "doc_id bigint, text string")


def model_for(spark: SparkSession) -> bytes:
    """The model file that `spark.thicket.sentencepiece` names, or the public one of this machine."""
    return read_model(spark.conf.get("spark.thicket.sentencepiece", MODEL))


