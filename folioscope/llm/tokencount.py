"""Token counts of whole texts with a public tokenizer.

Arrow functions encode batches and give back lengths only.  Texts are cut at safe places,
so that a long one never becomes one long call, and the parts of many rows are packed into
batches of about the same number of bytes.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm import words

BATCH_BYTES = 1 << 18
PART_BYTES = 1 << 16
TOKEN_LIMIT = 2048

# A blank behind an ASCII letter, comma or full stop and in front of an ASCII letter: neither
# normalisation, lower-casing nor a special string of the vocabulary reaches across it.  Texts
# without such places, as in other scripts, are one call whatever their length.
_SAFE = re.compile(rb"(?<=[A-Za-z,.]) (?=[A-Za-z])")


@lru_cache(maxsize=2)
def _counter(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_padding()
    model.no_truncation()
    encode = getattr(model, "encode_batch_fast", model.encode_batch)
    return lambda texts: [len(e) for e in encode(texts, add_special_tokens=False)]


def safe_parts(text: bytes, limit: int = PART_BYTES) -> Iterator[bytes]:
    """Cut a text into parts whose counts add up to that of the whole text.

    A cut is made in front of a blank between two ASCII letters; the blank, which the
    tokenizer drops, opens the next part.  Where no such place follows, the part goes on.
    """
    begin = 0
    while len(text) - begin > limit:
        cut = _SAFE.search(text, begin + limit)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    limit: int = TOKEN_LIMIT,
    splittable: bool = True,
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    ``tokenizer`` is the path of a vocabulary file that every executor has; ``splittable``
    says that it drops white space, else texts are encoded whole.  Null counts as an empty
    text.  Repeated rows stay, an empty table gives an empty result, other columns are
    ignored.
    """
    chosen = docs.select(
        docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).alias("text")
    )

    def run(batches):
        count = _counter(tokenizer)
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                data, offsets = words.buffers(piece.column(1))
                raw = data.tobytes()
                total = np.zeros(piece.num_rows, np.int64)
                parts, owner, held = [], [], 0

                def flush():
                    np.add.at(total, owner, count(parts))

                for row in range(piece.num_rows):
                    whole = raw[offsets[row] : offsets[row + 1]]
                    cuts = safe_parts(whole) if splittable else (whole,)
                    for part in cuts:
                        parts.append(part.decode("utf-8"))
                        owner.append(row)
                        held += len(part)
                        if held >= BATCH_BYTES:
                            flush()
                            parts, owner, held = [], [], 0
                if parts:
                    flush()
                columns = [
                    piece.column(0),
                    pa.array(np.diff(offsets)),
                    pa.array(total),
                    pa.array(total > limit),
                ]
                names = ["key", "n_bytes", "n_tokens", "over_limit"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = chosen.schema["key"].dataType.simpleString()
    counted = chosen.mapInArrow(
        run, f"key {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
    return counted.withColumnRenamed("key", key)
