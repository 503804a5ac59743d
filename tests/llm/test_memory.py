"""Memory of one task process, whatever a batch holds."""

import tracemalloc

import pyarrow as pa

from loadcast.llm import substring, textbytes


def test_word_hashes_of_a_large_batch_stay_small():
    """Six task processes share an executor's memory with the JVM: word hashes, windows and power tables of a batch are made slice by slice."""
    text = " ".join(f"word{i % 9_973}" for i in range(25_000))
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 40)], names=["text"])
    textbytes._powers.cache_clear()
    tracemalloc.start()
    for _, _, data, offsets in textbytes.slices(batch, "text"):
        words = textbytes.Words(data, offsets, lower=False)
        substring._sequence_digests(words), substring._runs(words, 50, 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20, peak
