"""Packing: every document is cut into pieces of power-of-two length, and pieces of equal length form a bucket.

A sequence is one piece, so it crosses no document and needs no padding; training
takes batches of equally long sequences from a bucket.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import number_rows, quoted, write_through

SEQUENCE = 2048
END_ID = 1
DOCS_AT_ONCE = 256
# Both libraries are known to split these characters alike; texts with others take the slower one.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-¬®-ɏ]*\Z")


def piece_lengths(n: int, longest: int = SEQUENCE) -> list[int]:
    """Powers of two that add up to ``n``, longest first, none above ``longest``."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << k for k in range(longest.bit_length() - 2, -1, -1) if rest >> k & 1]


class Encoder:
    """Ids of byte_bpe_50k.json; from its rank table where the text is plain, which is five times as fast."""

    def __init__(self, vocabulary: str, ranks: str | None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast and PLAIN.match(text) and not any(s in text for s in self.special):
            found = self.fast.encode_ordinary(text)
        else:
            found = self.slow.encode(text, add_special_tokens=False).ids
        out = np.empty(len(found) + 1, "<u4")
        out[:-1], out[-1] = found, END_ID
        return out


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def cut(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", longest: int = SEQUENCE,
    paths: tuple[str, str | None] | None = None, keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: the document's id as ``doc_id``, start, length, doc_tokens, ids_crc32 and, unless left out, ids.

    ``paths`` are those of the vocabulary and its rank table on the executors. Texts are
    read whole, one at a time. A null text is empty: its only piece is the end id. Of
    equal rows each gives its pieces; an empty table gives none; other columns are not carried.
    """
    vocabulary, ranks = paths or default_paths()
    kind = df.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, doc_tokens long, ids_crc32 long" + ", ids array<int>" * keep_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, ranks)
        last, found = None, None
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for low in range(0, len(texts), DOCS_AT_ONCE):
                rows = []
                for at in range(low, min(low + DOCS_AT_ONCE, len(texts))):
                    body = texts[at].as_py()
                    if found is None or body != last:
                        last, found = body, encoder.ids(body)
                    start = 0
                    for n in piece_lengths(len(found), longest):
                        own = found[start : start + n]
                        rows.append((at, start, n, len(found), zlib.crc32(own), own.astype("<i4") if keep_ids else None))
                        start += n
                cols = list(zip(*rows, strict=True))
                out = {"doc_id": keys.take(pa.array(cols[0]))}
                for k, name in enumerate(("start", "length", "doc_tokens", "ids_crc32"), 1):
                    out[name] = pa.array(cols[k], pa.int64())
                if keep_ids:
                    out["ids"] = pa.array(cols[5], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    body = F.coalesce(F.col(quoted(text)), F.lit(""))
    return df.select(F.col(quoted(doc_id)).alias("doc_id"), body.alias("text")).mapInArrow(pieces, schema)


def pack(df: DataFrame, text: str = "text", doc_id: str = "doc_id", keep_ids: bool = True, **options) -> DataFrame:
    """The pieces of ``cut`` with ``sequence_id`` and ``offset``, which is 0 as a sequence holds one piece.

    Sequence ids are gapless from 0 over all pieces, shortest bucket first, and
    depend on content alone: the same documents give the same ids. Pieces are written
    before they are numbered, so no text is tokenized twice.
    """
    pieces = write_through(cut(df, text, doc_id, keep_ids=keep_ids, **options), "pieces")
    return number_rows(pieces, "sequence_id", lead=("length",))[0].withColumn("offset", F.lit(0).cast("long"))
