import hashlib
import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from candlewright.llm import bpe, queries
from tests.llm.helpers import ROWS, documents

tokenizers = pytest.importorskip("tokenizers")
PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def table():
    return bpe.table_of(bpe.load(PATH))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def samples():
    r = random.Random(4)
    alphabet = " \n\t'st re'llAB09!?éß\x1c\x85 　漢字😀"
    yield from ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(800)]
    yield from ["a" * 5000, " " * 3000, "-" * 3333, "ab" * 4000, "<|endoftext|>" * 2 + "x<|endoftext|>", " \n" * 500, "", "x " * 200_000, "".join(r.choice("theing") for _ in range(9000))]


def test_encodes_and_decodes_as_the_library(table, library):
    encoder = bpe.Encoder(table)
    for text in samples():
        ids = encoder.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert bpe.Decoder(table).decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("block", [16, 64, 1 << 16])
def test_fed_in_pieces_the_ids_are_the_same(table, library, block):
    r = random.Random(block)
    encoder = bpe.Encoder(table, block=block)
    for text in samples():
        text = text[:6000]
        ids, lo = [], 0
        while lo < len(text):
            n = r.choice((1, 2, 7, 100, 5000))
            ids += [int(x) for part in encoder.feed(text[lo : lo + n]) for x in part.split(",")]
            lo += n
        ids += [int(x) for part in encoder.finish() for x in part.split(",")]
        assert ids == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("unit", ["theing", " ", "x y", "-=", "7", "<|endof", "\n\u3000"])
def test_memory_does_not_grow_with_the_text(table, unit):
    piece = unit * (50_000 // len(unit))

    def peak(times):
        encoder, decoder, held = bpe.Encoder(table, memo=1000), bpe.Decoder(table), 0
        tracemalloc.start()
        for _ in range(times):
            for part in encoder.feed(piece):
                decoder.feed(map(int, part.split(",")))
            held = max(held, len(encoder._raw) + len(encoder._text) + (len(encoder._open[1]._data) if encoder._open else 0))
        for _ in encoder.finish():
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert held <= 3 * bpe.BLOCK
        return most

    peak(2)
    assert peak(24) < 1.5 * peak(6)


def test_streamed_tokens_are_stable_with_the_least_window(table):
    r = random.Random(9)
    for _ in range(100):
        data = "".join(r.choice("-=_*xtheingor") for _ in range(1500)).encode()
        assert list(table.stream(data, table.lookahead + 130)) == table.merge(data)


def test_decoder_takes_ids_one_by_one_and_bad_bytes(table, library):
    r = random.Random(2)
    for _ in range(300):
        ids = [r.randrange(50257) for _ in range(r.randint(1, 12))]
        decoder = bpe.Decoder(table)
        assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


def test_memo_stays_bounded():
    memo = bpe.Memo(str, 10)
    assert [memo[k] for k in map(str, range(100))] == list(map(str, range(100)))
    assert len(memo) <= 10 and len(memo.old) <= 10


def test_documents_with_everything(spark, library):
    got = sorted(map(tuple, bpe.encode_documents(documents(spark), PATH).collect()), key=str)
    want = []
    for doc_id, text, *_ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.encode_documents(documents(spark).limit(0), PATH).count() == 0


def test_round_trip_of_ids(spark):
    tokens = bpe.encode_documents(documents(spark), PATH, with_ids=True)
    back = {r.doc_id: r.text for r in bpe.decode_documents(tokens, PATH).collect()}
    assert back == {d: t or "" for d, t, *_ in ROWS}
    empty = tokens.select("doc_id", F.lit(None).cast("array<int>").alias("ids"))
    assert all(r.text is None for r in bpe.decode_documents(empty, PATH).collect())
