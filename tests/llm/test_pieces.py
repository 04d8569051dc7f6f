"""Operator 11 against the public library: ids, byte ranges, decoding."""

import hashlib
import random

import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from binyard.llm import piece_encode
from binyard.llm.piece_encode import Normalizer, Pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = Pieces(open(PATH, "rb").read())
ODD = "ab  the▁  é☃\U0001F600\U0001F9FF\x00\n\t<0x41></s>中文字日本語٠١٢ᠠ​�́あ.,!?\"'«»²"


def same(text):
    ids, start, end = MODEL.encode(text)
    want = LIBRARY.encode(text)
    assert ids.tolist() == want
    assert list(zip(start.tolist(), end.tolist(), strict=True)) == [(p.begin, p.end) for p in LIBRARY.encode_as_proto(text).pieces] or not text
    assert MODEL.decode(ids) == LIBRARY.decode(want)


@given(st.text(max_size=80))
@settings(max_examples=400, deadline=None)
def test_any_text(text):
    same(text.encode("utf-8", "ignore").decode())


@given(st.text(alphabet=ODD, max_size=300))
@settings(max_examples=400, deadline=None)
def test_odd_characters(text):
    same(text)


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=12))
@settings(max_examples=400, deadline=None)
def test_decoding_of_any_ids(ids):
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


def test_long_cuts_and_windows(monkeypatch):
    rng = random.Random(2)
    letters = "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(5000))
    same(letters)
    same("中文字日本語" * 800)
    same(" " * 3000 + "x" + " " * 77)
    monkeypatch.setattr(piece_encode, "WINDOW", 50)
    monkeypatch.setattr(piece_encode, "CUTS", 20)
    small = Pieces(open(PATH, "rb").read())
    texts = ["".join(rng.choice(ODD) for _ in range(rng.choice([0, 3, 20, 400]))) for _ in range(60)] + [None]
    assert [x[0].tolist() for x in small.encode_all(texts)] == [LIBRARY.encode(t or "") for t in texts]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_compiled_character_maps(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    own, rng = Normalizer(library.serialized_normalizer_spec()), random.Random(rule)
    for _ in range(800):
        text = "".join(rng.choice("ab  ＡＢｃ①½ﬁé É́가각ー　\xa0\t\nﾊﾟＸ中Ⅷ㍿") for _ in range(rng.choice([0, 1, 3, 9, 30])))
        norm, source = own(text)
        assert norm == library.normalize(text)
        if norm and source is not None:
            places = source(__import__("numpy").arange(len(norm.encode()) + 1)).tolist()
            assert places == sorted(places) and places[-1] <= len(text.encode())


def test_spans_through_a_map_that_changes_lengths():
    own = Normalizer(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_normalizer_spec())
    text = "  ①ﬁ  x"
    norm, source = own(text)
    data, back = text.encode(), source(__import__("numpy").arange(len(norm.encode()) + 1))
    at = norm.encode().index(b"f")  # the ligature gives f and i, both from its first byte on
    assert data[back[at] : back[at + 2]].decode() == "ﬁ" and back[at] == back[at + 1]


def test_in_spark(spark):
    rows = [(1, "hello  world", "x"), (1, "hello  world", "y"), (None, "é☃ \U0001F9FF", "z"), (2, None, None), (3, "", None), (4, "w " * 40000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = piece_encode.encode(df, PATH)
    found = sorted(((r.doc_id or 0), r.ids, r.starts, r.ends) for r in got.collect())
    want = []
    for i, t, _ in rows:
        proto = LIBRARY.encode_as_proto(t or "").pieces if t else []
        want.append((i or 0, LIBRARY.encode(t or ""), [p.begin for p in proto], [p.end for p in proto]))
    assert found == sorted(want)
    back = sorted(((r.doc_id or 0), r.text) for r in piece_encode.decode(got.select("doc_id", "ids"), PATH).collect())
    assert back == sorted((i or 0, t or "") for i, t, _ in rows)
    assert piece_encode.encode(df.limit(0), PATH).count() == 0


def test_op11_on_the_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = piece_encode.op11(spark, sf).collect()
    assert len(rows) == len(docs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in rows:
        ids = LIBRARY.encode(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids)))
        assert r.covered_bytes == len(docs[r.doc_id].encode())
