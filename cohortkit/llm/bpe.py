"""Operator 1: byte-level BPE encoding and decoding by tree concatenation.

Texts up to ``LONG`` characters are encoded in one call. A longer text is cut
into chunks, the chunks are encoded in parallel by different tasks, and the
token lists are joined pairwise as a tree. At a join the last k tokens of the
left list and the first k of the right are re-encoded together; when the new
list begins with the left's first window token and ends with the right's last
one, both sides agree there and the middle is replaced, else k doubles until
it covers both lists. A token sequence is the encoding of its text exactly if
every adjacent pair is, so the result equals encoding the whole text at once.

Defined results: a null or empty text has no tokens; the special token's text
becomes its id; repeated rows are encoded alike; an empty table gives an empty
table; other columns pass through, and ``out`` replaces a column of its name.
Decoding: null ids give an empty text, ids outside the vocabulary are skipped,
bytes that are not UTF-8 become U+FFFD.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean

#: Characters from which a text is encoded in chunks, and characters of a chunk.
LONG, CHUNK = 65_536, 16_384
#: Rows whose values a worker holds at a time.
STEP = 512
#: Tokens on either side of a join in the first window.
WINDOW = 16
#: Scripts for which the two libraries' character classes are the same by the
#: exhaustive test in tests/llm; texts beyond them take the slower library.
_BEYOND = re.compile("[^\x00-ɏ‐-‧‰-⁞€]")


class Codec:
    """One vocabulary in a worker: ``path`` is a tokenizers JSON file. A library is
    loaded by the first text that needs it: a worker that decodes holds neither."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        back = {c: b for b, c in enumerate(_byte_chars())}
        self.ranks = {bytes(back[c] for c in tok): i for tok, i in spec["model"]["vocab"].items()
                      if tok not in self.special}

    @functools.cached_property
    def fast(self):
        import public_tokenizers
        import tiktoken

        return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks,
                                 special_tokens=self.special)

    @functools.cached_property
    def full(self):
        from tokenizers import Tokenizer

        full = Tokenizer.from_file(self.path)
        full.no_truncation()
        full.no_padding()
        return full

    @functools.cached_property
    def bytes_of(self) -> dict[int, bytes]:
        return {i: b for b, i in self.ranks.items()} | {i: s.encode() for s, i in self.special.items()}

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if _BEYOND.search(text):
            return self.full.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all", disallowed_special=())

    def raw(self, ids) -> bytes:
        get = self.bytes_of.get
        return b"".join([get(i, b"") for i in ids])

    def decode(self, ids) -> str:
        return self.raw(ids).decode("utf-8", "replace")

    def concat(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left + right
        k = WINDOW
        while True:
            i, j = max(0, len(left) - k), min(len(right), k)
            k *= 2
            try:
                window = self.raw(left[i:] + right[:j]).decode("utf-8")
            except UnicodeDecodeError:  # an edge lies inside a character
                continue
            mid = self.encode(window)
            if (i == 0 or mid[0] == left[i]) and (j == len(right) or mid[-1] == right[j - 1]):
                return left[:i] + mid + right[j:]

    def tree(self, parts: list[list[int]]) -> list[int]:
        while len(parts) > 1:
            parts = [self.concat(parts[n], parts[n + 1]) if n + 1 < len(parts) else parts[n]
                     for n in range(0, len(parts), 2)]
        return parts[0] if parts else []


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: the
    byte's own character if it is visible in Latin-1, else the next code point
    from 256 on."""
    out, nxt = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(nxt))
            nxt += 1
    return out


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def _pack(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def _ids_array(packed: bytes | None) -> list[int]:
    return np.frombuffer(packed, dtype="<u4").tolist() if packed else []


def _mapped(df: DataFrame, col: str, out: str, arrow: pa.DataType, kind: T.DataType, fn) -> DataFrame:
    """``df`` with ``out`` = fn(list of ``col``'s values), all other columns as they are.
    A batch passes in steps, so a worker holds the values of ``STEP`` rows."""
    rest = df.drop(out) if out != col else df.withColumnRenamed(col, "__in").withColumn(out, F.lit(None))
    src = "__in" if out == col else col
    rest = rest if out != col else rest.drop(out)
    schema = T.StructType([f for f in rest.schema.fields if f.name != "__in"] + [T.StructField(out, kind)])
    keep = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                b = whole.slice(at, STEP)
                values = fn(b.column(b.schema.get_field_index(src)).to_pylist())
                cols = [b.column(b.schema.get_field_index(k)) for k in keep] + [pa.array(values, arrow)]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, out])

    return rest.mapInArrow(run, schema)


def encode_packed(df: DataFrame, path: str, text: str = "text", out: str = "ids",
                  long: int = LONG, chunk: int = CHUNK) -> DataFrame:
    """``df`` with ``out``: the ids as little-endian unsigned 32-bit integers."""
    size = F.coalesce(F.char_length(F.col(text)), F.lit(0))
    short = _mapped(df.where(size <= long), text, out, pa.binary(), T.BinaryType(),
                    lambda xs: [_pack(codec(path).encode(x or "")) for x in xs])
    big = df.where(size > long).withColumn("__key", F.sha2(F.col(text), 256))

    def chunks(batches):
        for b in batches:
            for key, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for n, at in enumerate(range(0, len(x), chunk)):
                    yield pa.RecordBatch.from_pylist([{"key": key, "n": n, "part": x[at:at + chunk]}])

    def encode_chunks(batches):
        for b in batches:
            ids = [_pack(codec(path).encode(x)) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())],
                                             names=["key", "n", "ids"])

    def join_text(key, tab):
        tab = tab.sort_by("n")
        parts = [_ids_array(x) for x in tab.column("ids").to_pylist()]
        return pa.table({"__key": pa.array([key[0].as_py()], pa.string()),
                         out: pa.array([_pack(codec(path).tree(parts))], pa.binary())})

    parts = (big.select("__key", text).mapInArrow(chunks, "key string, n long, part string")
             .dropDuplicates(["key", "n"]).repartition("key", "n")
             .mapInArrow(encode_chunks, "key string, n long, ids binary"))
    whole = parts.groupBy("key").applyInArrow(join_text, f"__key string, `{out}` binary")
    big = (big.drop(out) if out != text else big.withColumnRenamed(text, "__in").drop("__in"))
    done = big.join(whole, "__key").select(*short.columns)
    return short.unionByName(done)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out``: the token ids of ``text`` as array<int>."""
    packed = encode_packed(df, path, text, "__packed")
    return _mapped(packed, "__packed", out, pa.list_(pa.int32()), T.ArrayType(T.IntegerType()),
                   lambda xs: [_ids_array(x) for x in xs]).drop("__packed")


def decode_packed(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    return _mapped(df, ids, out, pa.string(), T.StringType(),
                   lambda xs: [codec(path).decode(_ids_array(x)) for x in xs])


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of the array<int> column ``ids``."""
    return _mapped(df, ids, out, pa.string(), T.StringType(),
                   lambda xs: [codec(path).decode(x or []) for x in xs])


def ids_digest(ids) -> str:
    return hashlib.sha256(_pack(ids)).hexdigest()


def op1(docs: DataFrame, path: str) -> DataFrame:
    enc = encode_packed(docs.select("doc_id", "text"), path).select("doc_id", "ids")
    dec = decode_packed(enc, path)
    return dec.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
