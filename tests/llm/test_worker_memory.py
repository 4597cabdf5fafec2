"""What tasks hold and leave behind in Python workers, which live on between stages."""

import re
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from propscan.llm import batches, packing
from propscan.llm import ngram_jaccard_join as J
from propscan.llm.quality_rules import _counted


def resident() -> int:
    with open("/proc/self/status") as f:
        return int(re.search(r"VmRSS:\s+(\d+)", f.read())[1]) >> 10  # MB


def bucket(n: int, of: int = 400) -> pa.Table:
    """A bucket of ``n`` tokens in sets of ``of``, each token in about two sets of ten."""
    rnd = np.random.default_rng(3)
    names, sizes = np.arange(n // of), np.full(n // of, of, np.int32)
    tokens = rnd.integers(0, 10 * n, n).astype(np.uint64)
    return pa.Table.from_batches([J._by_bucket(names, sizes, np.repeat(np.arange(n // of, dtype=np.int32), of), np.zeros(n, np.int32), tokens, 6)])


def peak(run) -> int:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("grouped", [False, True])
def test_freed_memory_goes_back_to_the_system(grouped):
    held = []

    def fill():
        many = [np.ones(8000) for _ in range(3000)]  # 190 MB in blocks of the C heap
        held.append(np.ones(8000))  # lies above them, so the heap can't shrink by itself
        del many

    def task(given):
        fill()
        yield from given

    before, table = resident(), pa.table([np.zeros(1 << 18)], names=["x"])
    if grouped:
        batches.released_group(lambda t: fill() or t)(table)
    else:
        list(batches.released(task)(iter(table.to_batches())))
    assert resident() - before < 60


def test_a_bucket_of_tokens_takes_little_besides():
    n = 400_000
    table = bucket(n)
    assert peak(lambda: J._shared_tokens(8)(table)) < 38 * n


def test_texts_are_looked_at_in_small_chunks():
    text = " ".join(f"w{i % 977}" for i in range(300))
    rows = pa.record_batch([pa.array([text] * 2000), pa.array([""] * 2000)], names=["text", "stratum"])
    docs = pa.record_batch([pa.array(range(2000)), *rows.columns], names=["id", *rows.schema.names])
    assert peak(lambda: sum(len(b) for b in J._document_sets(5, 64)(iter([rows])))) < 18 << 20
    assert peak(lambda: sum(len(b) for b in _counted(iter([docs])))) < 18 << 20


def test_packing_starts_no_workers_for_its_plan(spark):
    docs = spark.createDataFrame([(i, "one two three " * (i + 1)) for i in range(30)], "doc_id long, text string")
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    assert "ExistingRDD" not in packed._jdf.queryExecution().executedPlan().toString()
    assert packed.count() == 30
