"""Byte-level BPE in small steps: the same ids, and a worker's caches stay bounded."""

import numpy as np
import public_tokenizers
import pyarrow as pa

from tallyline.llm import bpe, words


def test_steps_give_the_same_ids_and_caches_stay_bounded():
    texts = [" ".join(f"w{k * 40 + i}x" for i in range(40)) for k in range(12000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(12000)), pa.array(texts)], ["doc_id", "text"])
    one = bpe.ByteBpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    whole, _ = one.encode_batch(batch.column(1))
    two = bpe.ByteBpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    parts, most = [], 0
    for part in words.steps(batch, 1, bpe.STEP):
        parts.append(two.encode_batch(part.column(1))[0])
        most = max(most, len(two.segments.young) + len(two.segments.old))
    assert len(parts) > 1 and np.array_equal(np.concatenate(parts), whole)
    assert most < 300_000  # of 480,000 distinct words
