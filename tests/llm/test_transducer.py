"""The transducer against the library, on the public model and on small ones of every kind."""

import random

import numpy as np
import public_tokenizers
import pytest

from storyloom.llm import wfst

sentencepiece = pytest.importorskip("sentencepiece")

UNIGRAM = [("▁", -4), ("a", -3), ("b", -3.5), ("ab", -4.1), ("ba", -4.53), ("▁a", -5.2), ("aba", -6.23), ("▁ab", -7.71), ("a▁b", -6.05), ("▁▁", -5.5)]
BPE = [("▁a", -1), ("ab", -2), ("▁ab", -3), ("ba", -4), ("▁▁", -5), ("aab", -6), ("é▁", -7), ("▁", -8), ("a", -9), ("b", -10)]
OWN = ("<x>", "<x>a", "ab!")


def small_model(path, bpe, dummy, squeeze, fallback, own=()):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.trainer_spec.model_type = pb.TrainerSpec.BPE if bpe else pb.TrainerSpec.UNIGRAM
    m.trainer_spec.byte_fallback = fallback
    norm = m.normalizer_spec
    norm.name, norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces = "identity", dummy, squeeze, True
    for piece, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        m.pieces.add(piece=piece, score=0, type=kind)
    for b in range(256 if fallback else 0):
        m.pieces.add(piece=f"<0x{b:02X}>", score=0, type=6)
    for piece in own:
        m.pieces.add(piece=piece, score=0, type=4)
    for piece, score in BPE if bpe else UNIGRAM:
        m.pieces.add(piece=piece, score=score, type=1)
    path.write_bytes(m.SerializeToString())
    return str(path)


def both(path):
    library, machine = sentencepiece.SentencePieceProcessor(model_file=path), wfst.Transducer(path)
    return library.encode, lambda text: np.frombuffer(machine.encode(text), "<u4").tolist()


@pytest.mark.parametrize("bpe", [False, True])
@pytest.mark.parametrize("dummy", [False, True])
@pytest.mark.parametrize(("squeeze", "own"), [(False, ()), (True, ()), (False, OWN)])
@pytest.mark.parametrize("fallback", [False, True])
def test_small_models(tmp_path, bpe, dummy, squeeze, own, fallback):
    want, got = both(small_model(tmp_path / "m.model", bpe, dummy, squeeze, fallback, own))
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", " ", "x", "é", "ab", "aab", "<x>", "!"]) for _ in range(rng.randrange(14)))
        assert got(text) == want(text), text


def test_runs_of_unknown_characters_are_one_id(tmp_path):
    want, got = both(small_model(tmp_path / "m.model", False, False, False, False))
    assert got("xyz") == want("xyz") == [0] and got("abxyab") == want("abxyab")


def test_very_long_text():
    want, got = both(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(9)
    text = " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 12))) for _ in range(20_000)) + "漢" * 5000 + " " * 300
    assert got(text) == want(text)
    assert got("e" * 3000) == want("e" * 3000)


def test_machine_is_composed_of_normaliser_and_pieces():
    machine = wfst.composed(wfst.normaliser(True, False), {"▁": 3, "a": 4, "▁a": 5}, True)
    state = machine.steps[machine.steps[machine.start][" "]]["a"]
    assert machine.ends[state][0] == 5 and machine.ends[machine.steps[machine.start]["▁"]][0] == 3
    to, writes = machine.loops[machine.start]
    assert writes and machine.loops[to] == (to, False)  # a run goes round without writing
    squeezed = wfst.composed(wfst.normaliser(False, True), {"▁": 3, "a": 4}, False)
    assert squeezed.forks


@pytest.mark.parametrize("rows", [[], [(None, "a b"), (1, None), (1, ""), (2, "same"), (2, "same")]])
def test_odd_tables(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'own' as ids", "1 as n_tokens")
    got = [(r["doc_id"], len(r["ids"]) > 0) for r in wfst.encode(table).collect()]
    assert sorted(got, key=repr) == sorted([(d, bool(t)) for d, t in rows], key=repr)


def test_query_is_the_librarys(spark, tmp_path):
    import zlib

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = [(1, "Hello  there\n\n漢字"), (2, None), (None, "x"), (2, "rep"), (2, "rep"), (3, " ▁ literal")]
    spark.createDataFrame(texts, "doc_id long, text string").selectExpr("doc_id", "text", "true as same").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, wfst.op2_sentencepiece(spark, str(tmp_path)).collect()), key=repr)
    want = []
    for d, t in texts:
        ids = library.encode(t or "")
        want.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), library.decode(ids) == (t or "")))
    assert got == sorted(want, key=repr)
