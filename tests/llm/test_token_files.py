"""Token files against the tokenizers library and plain lists."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import token_files as T
from ledgerlake.session import scratch_path

SCHEMA = "doc_id long, text string, start string, part int"


@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], [3, 3, 9, 2**40, 2**62], list(range(0, 50_000, 3)), [1] * 5000 + [10**9] * 3,
                                    sorted(random.Random(1).randrange(10**6) for _ in range(20_000))])
def test_select_equals_the_sequence(values):
    made = T.Monotone.encode(np.array(values, dtype=np.uint64))
    back = T.Monotone.read(len(values), made.bits, *made.sections())
    assert back.select(np.arange(len(values))).tolist() == values
    some = random.Random(2).choices(range(len(values)), k=50) if values else []
    assert back.select(np.array(some, dtype=np.int64)).tolist() == [values[k] for k in some]


def test_ends_take_near_minimal_space():
    ends = np.cumsum(np.random.default_rng(3).integers(1, 800, 100_000))
    bits = 8 * sum(map(len, T.Monotone.encode(ends).sections())) / len(ends)
    assert bits < 2.4 + np.log2(ends[-1] / len(ends))  # against 64 in a table


def test_encoder_equals_the_library_on_whole_texts():
    r = random.Random(4)
    alphabet = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　'stdlrevm aZΣσİßéÑé̀ﬁ日本🙂<|endoftext|>1२½.,!"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["a <|endoftext|> b<|startoftext|>c", "<|endof text|>", "don't WE'LL 's ''s !'s x'stuff", " ́a e ́", "", None, "x" * 3000, "ΑΣ ΑΣ. Σ"]
    texts += ["".join(r.choice("abcXYZ'éÉèßñÑŸſĳŒœ²½0٣.,!?<|>-_ªº\xad\x1c ") for _ in range(r.randint(0, 30))) for _ in range(5000)]
    texts += [" ".join(chr(c) + "a" + chr(c) + "'s" + chr(c) for c in range(1, 0x250)), " ".join(chr(c) for c in range(1, 0x3000) if chr(c).strip())]
    library = Tokenizer.from_file(T.default_path())
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    encoder = T.Encoder(T.default_path())
    assert encoder.width == 2 and [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(texts)] == want
    assert [np.frombuffer(b, "<u2").tolist() for b in T.Encoder(T.default_path(), spaced=False).encode(texts)] == want


def test_files_round_trip(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdeinorst") for _ in range(r.randint(1, 8)))
    texts = [" ".join(word() for _ in range(r.choice([0, 1, 30, 200]))) for _ in range(300)] + [None, "", "long " * 40_000, "same", "same"]
    ids = [r.choice([k, k, -k, 10**12 + k]) for k in range(300)] + [None, None, 77_777, 88_888, 88_888]
    path = scratch_path(spark, "token-files-test")
    T.write_token_files(spark.createDataFrame([(d, t, "clash", 1) for d, t in zip(ids, texts, strict=True)], SCHEMA).repartition(5), path, block_ids=2000)
    got = sorted(T.read_token_files(spark, path).collect(), key=lambda x: x.start)
    library = Tokenizer.from_file(T.default_path())
    made = {}
    for d, t in zip(ids, texts, strict=True):
        made.setdefault(d, []).append([*library.encode(t or "", add_special_tokens=False).ids, T.END])
    assert [x.doc_id for x in got] == sorted(ids, key=lambda d: (d is not None, d or 0))
    at = 0
    for x in got:
        back = np.frombuffer(x.ids, "<u4").tolist()
        made[x.doc_id].remove(back)
        assert x.start == at and x.n_tokens == len(back) and x.ids_crc32 == zlib.crc32(x.ids)
        at += len(back)
    files = [T.Block(f.content) for f in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    assert len(files) > 10 and sum(b.n_docs for b in files) == len(ids)
    home = next(b for b in files if b.find(77_777) is not None)
    assert home.ids(home.find(77_777)).tolist()[:2] == library.encode("long long", add_special_tokens=False).ids and sum(b.find(123_456_789) is not None for b in files) == 0
    assert sorted(b.first_doc for b in files)[0] == 0 and {b.first_doc + b.n_docs for b in files} - {b.first_doc for b in files} == {len(ids)}


def test_nothing_to_write(spark):
    assert T.token_files(spark.createDataFrame([], SCHEMA)).count() == 0
    assert T.read_token_files(spark, scratch_path(spark, "nowhere")).count() == 0
