"""What a Python worker keeps and builds at a time."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from secflow.llm import bpe, suffix_dedup


def test_encoder_remembers_letters_once_and_asks_for_few_texts_at_a_time(monkeypatch):
    monkeypatch.setattr(bpe, "LIBRARY_TEXTS", 16)
    enc = bpe.Encoder(bpe.default_tokenizer())
    asked = []

    class Spy:
        def encode_batch_fast(self, texts, **kw):
            asked.append(len(texts))
            return tok.encode_batch_fast(texts, **kw)
    tok, enc.tok = enc.tok, Spy()
    texts = [" ".join(f"wörd{chr(97 + i)}{m}" for m in ("", ",", ".", "!:", ")")) for i in range(26)] + [None, "", "a  b"]
    got = [bytes(x) for x in enc.texts(pa.array(texts))]
    assert max(asked) <= 16
    assert got == [np.array(tok.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert not any(k.endswith((",", ".", "!:", ")")) for k in enc.known if k[0] != "\t")


def test_runs_of_a_block_take_a_byte_per_position_beside_the_keys():
    """The whole block is unlike text, so that keys and flags are all that is as long as the block."""
    rnd = random.Random(1)
    texts = ["".join(rnd.choices("abcdefghijklmnop ", k=4000)) for _ in range(500)]
    raw = [t.encode() for t in texts]
    n = sum(map(len, raw))
    left = pa.Table.from_batches(list(_packed(texts)))
    grams = suffix_dedup._frame(np.array([1], "<u8"), np.zeros(1, np.uint8), np.zeros(0, "<i4"))
    right = pa.table({"bucket": pa.array([0], pa.int32()), "block": pa.array([0], pa.int64()),
                      "payload": pa.array([grams], pa.binary())})
    run = suffix_dedup._send_runs(4, 100, 24)
    tracemalloc.start()
    try:
        out = run(left, right)
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert out.num_rows == 0
    assert peak < 20 * n


def _packed(texts):
    from unittest import mock
    with mock.patch.object(bpe, "TaskContext") as ctx:
        ctx.get.return_value.partitionId.return_value = 0
        b = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
        yield from suffix_dedup._pack_texts(64 << 20)([b])


def test_new_words_of_letters_reach_the_library_as_lines_of_one_text():
    enc = bpe.Encoder(bpe.default_tokenizer(), limit=400)
    asked = []

    class Spy:
        def encode_batch_fast(self, texts, **kw):
            asked.append(len(texts))
            return tok.encode_batch_fast(texts, **kw)
    tok, enc.tok = enc.tok, Spy()
    rnd = random.Random(7)
    for _ in range(4):      # more words than are remembered
        some = ["".join(rnd.choices("aeiounrstéöß", k=rnd.randrange(1, 9))) for _ in range(300)] + ["x" * 200, "l" * 70]
        texts = ["a " + " ".join(w + rnd.choice(["", ",", "2.", "!!"]) for w in some), "\nb c\n" + " ".join(some[:40]), None]
        got = [bytes(x) for x in enc.texts(pa.array(texts))]
        assert got == [np.array(tok.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert sum(asked) < 60
    assert len(enc.words.ends) <= 402 and not any(len(k) > bpe.LONG_WORD for k in enc.known)


def test_freed_memory_leaves_the_process():
    from secflow.llm.common import give_back

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096
    few = [bytes(5000) for _ in range(40000)]
    kept, full = few[::4000], resident()
    del few
    give_back()
    assert kept and full - resident() > 100 << 20
