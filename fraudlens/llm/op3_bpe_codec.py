"""BPE encoding and decoding by tree concatenation.

Texts are encoded in the partition they lie in.  A text longer than
``PIECE_CHARS`` is cut into pieces, preferably between pre-tokens and inside
one only where it is itself that long; the pieces are dealt over all tasks
with the sizes of their pre-tokens (the splitting rule looks ahead, so a piece
cannot be split anew), encoded in parallel, and joined pairwise as a tree, one
task per text.  A join between pre-tokens needs no repair, a join inside a pre-token
re-encodes a window around it that grows until both sides agree
(``bpe.Encoder.join``); long unsplit stretches inside a piece are encoded by
halves in the same way.  The result is exactly the library's.

Memory is bounded by one text and its ids, as rows are.

Defined cases: null is encoded as the empty text (no ids, decoded ""); texts
of any length are encoded whole; added-token strings in a text become their
ids (the library's default); repeated rows give repeated results; an empty
table gives an empty result; an input column named like an output is
replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.llm import bpe
from fraudlens.llm.common import TEXT, arrow_map, arrow_type, map_text, table

PIECE_CHARS = 1 << 16
OUTPUTS = {"ids": "array<int>", "n_tokens": "long", "ids_sha256": "string",
           "decoded": "string", "decoded_sha256": "string"}
QUERY_OUTPUTS = ("n_tokens", "ids_sha256", "decoded_sha256")


def columns_of(enc: bpe.Encoder, raw: bytes, outputs) -> list:
    """The wanted output values of one text's little-endian uint32 ids."""
    ids = np.frombuffer(raw, "<u4").tolist()
    decoded = enc.decode(ids) if {"decoded", "decoded_sha256"} & set(outputs) else None
    made = {
        "ids": lambda: ids,
        "n_tokens": lambda: len(ids),
        "ids_sha256": lambda: hashlib.sha256(bpe.ids_text(enc, ids).encode()).hexdigest(),
        "decoded": lambda: decoded,
        "decoded_sha256": lambda: hashlib.sha256(decoded.encode("utf-8")).hexdigest(),
    }
    return [made[o]() for o in outputs]


def token_pieces(enc: bpe.Encoder, text: str, size: int = PIECE_CHARS) -> list[tuple[list[str], bool]]:
    """(tokens, inside): the text's pre-tokens and added tokens in consecutive
    pieces of at most about ``size`` characters; ``inside`` marks a part of a
    pre-token that continues the one in which the piece before it ended."""
    out: list[tuple[list[str], bool]] = []
    held: list[str] = []
    n_held = 0

    def flush():
        nonlocal held, n_held
        if held:
            out.append((held, False))
            held, n_held = [], 0

    for stretch, added in enc.segments(text):
        for token in [stretch] if added is not None else enc.pretokens(stretch):
            if n_held + len(token) > size:
                flush()
            if added is None and len(token) > size:
                out.extend(([token[i:i + size]], i > 0) for i in range(0, len(token), size))
            else:
                held.append(token)
                n_held += len(token)
    flush()
    return out


def pieces(enc: bpe.Encoder, text: str, size: int = PIECE_CHARS) -> list[tuple[str, bool]]:
    """``token_pieces`` with the tokens of a piece joined."""
    return [("".join(tokens), inside) for tokens, inside in token_pieces(enc, text, size)]


def encode_piece(enc: bpe.Encoder, piece: str, alone: bool, sizes: bytes) -> bytes:
    """Ids of a piece: its tokens of ``sizes`` characters (uint32), or
    (``alone``) a part of one pre-token.  The piece is not split anew: the
    rule looks ahead, so white space at its end would be split otherwise."""
    if alone:
        return np.array(enc.tree(enc.mapped(piece)), dtype="<u4").tobytes()
    ends = np.cumsum(np.frombuffer(sizes, "<u4")).tolist()
    return enc.encode_tokens([piece[a:b] for a, b in zip([0, *ends], ends)])


def join_tree(enc: bpe.Encoder, parts: list[tuple[list[int], bool]]) -> list[int]:
    """Join neighbouring parts pairwise, level by level."""
    while len(parts) > 1:
        level = []
        for i in range(0, len(parts) - 1, 2):
            (left, inside), (right, continues) = parts[i], parts[i + 1]
            level.append((enc.join(left, right) if continues else left + right, inside))
        if len(parts) % 2:
            level.append(parts[-1])
        parts = level
    return parts[0][0] if parts else []


def _group_parts(parts: list[tuple[bytes, bool, bool]], enc: bpe.Encoder) -> bytes:
    """Bytes of all ids of a text from its pieces in order.  Runs of parts of
    one pre-token are joined as trees; everything else is concatenated."""
    out, run = [], []

    def close():
        if run:
            out.append(np.array(join_tree(enc, list(run)), dtype="<u4").tobytes())
            run.clear()

    for raw, alone, inside in parts:
        if not inside:
            close()
        if alone:
            run.append((np.frombuffer(raw, "<u4").tolist(), inside))
        else:
            close()
            out.append(raw)
    close()
    return b"".join(out)


def encode_decode(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None,
                  outputs: tuple = ("ids", "n_tokens", "decoded"),
                  keep: list[str] | None = None, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``docs`` with the wanted ``outputs`` (names of ``OUTPUTS``)."""
    path = tokenizer or bpe.default_path()
    ddl = ", ".join(f"`{o}` {OUTPUTS[o]}" for o in outputs)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    long_text = F.length(docs[text_col]) > piece_chars

    def encode(texts):
        enc = bpe.encoder(path)
        rows = [columns_of(enc, enc.encode(t or ""), outputs) for t in texts]
        return list(zip(*rows))

    short = map_text(docs.where(~F.coalesce(long_text, F.lit(False))), encode, ddl, text_col, keep)
    long = _long_texts(docs.where(long_text), text_col, path, outputs, ddl, keep, piece_chars)
    return short.unionByName(long)


def _long_texts(docs: DataFrame, text_col, path, outputs, ddl, keep, size) -> DataFrame:
    row = F.struct(*[docs[c] for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    source = docs.select(F.monotonically_increasing_id().alias("row"), row.alias("kept"),
                         docs[text_col].alias(TEXT))
    kept_type = source.schema["kept"].dataType
    cut_schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("piece", T.IntegerType()),
        T.StructField("alone", T.BooleanType()), T.StructField("inside", T.BooleanType()),
        T.StructField("kept", kept_type), T.StructField(TEXT, T.StringType()),
        T.StructField("sizes", T.BinaryType())])

    def cut(batches):
        enc = bpe.encoder(path)
        for batch in batches:
            for i in range(batch.num_rows):
                parts = token_pieces(enc, batch.column(2)[i].as_py(), size)
                n = len(parts)
                first = pa.concat_arrays([batch.column(1).slice(i, 1),
                                          pa.nulls(n - 1, batch.column(1).type)])
                inside = [x for _, x in parts]
                alone = [inside[k] or (k + 1 < n and inside[k + 1]) for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * n, pa.int64()),
                     pa.array(range(n), pa.int32()), pa.array(alone), pa.array(inside), first,
                     pa.array(["".join(p) for p, _ in parts], arrow_type(T.StringType())),
                     pa.array([np.array([len(t) for t in p], "<u4").tobytes() for p, _ in parts], pa.binary())],
                    names=cut_schema.names)

    coded_schema = T.StructType(cut_schema.fields[:5] + [T.StructField("raw", T.BinaryType())])

    def code(batches):
        enc = bpe.encoder(path)
        for batch in batches:
            raw = [encode_piece(enc, *row) for row in zip(*(batch.column(k).to_pylist() for k in (5, 2, 6)))]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(5)]
                                             + [pa.array(raw, pa.binary())],
                                             names=coded_schema.names)

    out_schema = T.StructType([T.StructField("kept", kept_type)] + list(T.StructType.fromDDL(ddl)))
    types = [arrow_type(f.dataType) for f in out_schema]

    def join(batches):
        enc = bpe.encoder(path)

        def made(kept, parts):
            values = columns_of(enc, _group_parts(parts, enc), outputs)
            return pa.RecordBatch.from_arrays(
                [kept] + [pa.array([v], type=t) for v, t in zip(values, types[1:])],
                names=out_schema.names)

        row, kept, parts = None, None, []
        for batch in batches:
            for i, (r, raw, alone, inside) in enumerate(zip(
                    *(batch.column(k).to_pylist() for k in (0, 5, 2, 3)))):
                if r != row:
                    if parts:
                        yield made(kept, parts)
                    row, kept, parts = r, batch.column(4).slice(i, 1), []
                parts.append((raw, alone, inside))
        if parts:
            yield made(kept, parts)

    dealt = arrow_map(source, cut, cut_schema).repartition("row", "piece")
    coded = arrow_map(dealt, code, coded_schema).repartition("row")
    joined = arrow_map(coded.sortWithinPartitions("row", "piece"), join, out_schema)
    return joined.select(*[F.col("kept")[c].alias(c) for c in keep], *outputs)


def query(spark, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), outputs=QUERY_OUTPUTS, keep=["doc_id"])
