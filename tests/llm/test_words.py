import pyarrow as pa

from loanlake.llm import words


def test_slices_are_small_and_freed_memory_is_given_back(monkeypatch):
    released = []
    monkeypatch.setattr(words, "release_memory", lambda: released.append(True))
    texts = ["é" * n for n in (300_000, 300_000, 10, 1_200_000, 5)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    found = list(words.slices([batch], "text"))
    assert pa.Table.from_batches(found).column("text").to_pylist() == texts
    sizes = [sum(len((t or "").encode()) for t in b.column("text").to_pylist()) for b in found]
    assert all(size <= 1_000_000 or b.num_rows == 1 for size, b in zip(sizes, found, strict=True))
    assert released == [True]
