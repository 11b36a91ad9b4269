"""Token id files, packing, and piece counts."""

from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brightledger.llm import idfiles, ids, packing, pieces
from brightledger.llm.queries import QUERIES, vocabulary

from .cases import documents, none, prose


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


def encoded(tokenizer, text, end):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_words_encode_like_whole_texts(tokenizer, spark, sf_dir, monkeypatch):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    texts += [
        None, "", "  ", "it's I'LL we'd 'S's a''", "İstanbul ΣΑΣ ²½ ﬁx é ߀", "<|endoftext|> a <|startoftext|>",
        "a\x1cb \x1f c\x85d e\xa0f", "x" * 5_000, "ÀÉß ÷× ª º", "12.5km 7'8 __'d_", "漢字かな 😀😀", "á ́b",
    ]
    encoder = ids.WordEncoder(vocabulary())
    for text in texts:
        assert (encoder.encode(text, 7) == encoded(tokenizer, text, 7)).all(), text
    monkeypatch.setattr(ids, "KEPT_BYTES", 3 * ids.ENTRY_BYTES)
    small = ids.WordEncoder(vocabulary())
    for text in texts[:20]:
        assert (small.encode(text, 7) == encoded(tokenizer, text, 7)).all()
    assert len(small.known.new) <= 4 and len(small.parts.old) <= 4
    small.forget()
    assert not small.known.new and not small.parts.old and (small.encode(texts[0], 7) == encoded(tokenizer, texts[0], 7)).all()
    assert ids.byte_letters()[ord("A")] == "A" and len(set(ids.byte_letters().values())) == 256


def test_id_files_round_trip(spark, tokenizer):
    df = documents(spark)
    files, keys = idfiles.write_id_files(df, vocabulary(), shard_bytes=30_000, bucket_keys=4)
    read = files.payload(files.located(keys), idfiles.ids_crc32).join(files.shards(), "shard").collect()
    rows = sorted(df.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    found = sorted(read, key=lambda r: r["first_id"] + r["offset"])
    assert [r["doc_id"] for r in found] == [r["doc_id"] for r in rows]
    start = 0
    for r, given in zip(found, rows):
        wanted = encoded(tokenizer, given["text"], 2)
        assert (r["first_id"] + r["offset"], r["length"], r["digest"]) == (start, len(wanted), crc32(wanted.tobytes()))
        start += len(wanted)
    assert {(r["doc_id"], r["copy"]) for r in read} >= {(25, 0), (25, 1), (None, 0)}
    assert files.shards().count() > 1
    missing = spark.createDataFrame([(999, 0), (25, 2), (None, 1)], "doc_id long, copy long")
    assert files.located(missing).count() == 0


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    made = idfiles.PerfectHash.over(np.unique(keys))
    again = idfiles.PerfectHash.unpacked(made.packed())
    assert sorted(again.numbers(np.unique(keys))) == list(range(len(np.unique(keys))))
    assert idfiles.PerfectHash.over(keys[:0]).numbers(keys[:3]).tolist() == [-1, -1, -1]
    with pytest.raises(ValueError):
        idfiles.PerfectHash.over(keys[[0, 0]])


def test_id_files_of_an_empty_table(spark):
    files, keys = idfiles.write_id_files(none(spark), vocabulary())
    assert files.payload(files.located(keys), idfiles.ids_crc32).count() == 0


def test_op5_query(spark, sf_dir, tokenizer):
    found = {r["doc_id"]: r for r in QUERIES["op5_id_files"](spark, sf_dir).collect()}
    start = 0
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        wanted = encoded(tokenizer, r["text"], 2)
        row = found[r["doc_id"]]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(wanted), crc32(wanted.tobytes()))
        start += len(wanted)


def check_pieces(rows, wanted, capacity):
    """Each id in one piece, sequences gapless and within capacity."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(wanted)
    for doc, parts in by_doc.items():
        parts.sort(key=lambda r: r["start"])
        held = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in parts])
        assert [r["start"] for r in parts] == np.cumsum([0] + [r["length"] for r in parts])[:-1].tolist()
        assert all(r["doc_tokens"] == len(held) for r in parts) and (held == wanted[doc]).all()
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in parts] == np.cumsum([0] + [r["length"] for r in parts])[:-1].tolist()
        assert sum(r["length"] for r in parts) <= capacity
        cost = sum(r["length"] * packing.LINEAR + packing.QUADRATIC * r["length"] ** 2 for r in parts)
        assert all(abs(r["cost"] - cost) < 1e-6 for r in parts)
    return by_sequence


def test_packing_keeps_every_id_once(spark, tokenizer):
    df = documents(spark).withColumn("Length", F.lit("clash")).withColumn("block", F.lit(3))
    tagged = df.withColumn("doc", F.concat_ws("/", F.coalesce("doc_id", F.lit(-1)), F.monotonically_increasing_id())).cache()
    wanted = {r["doc"]: encoded(tokenizer, r["text"], 1) for r in tagged.collect()}
    made = packing.pack(tagged, vocabulary(), capacity=256, block_bytes=20_000)
    assert "block" in made.columns and made.columns.count("length") == 1 and "Length" not in made.columns
    rows = made.collect()
    sequences = check_pieces([r.asDict() for r in rows], wanted, 256)
    tokens = sum(map(len, wanted.values()))
    assert len(sequences) <= -(-tokens // 256) + len({s >> 32 for s in sequences})
    tagged.unpersist()


def test_descending_pieces_go_to_the_cheapest_sequence_with_room():
    parts = packing.assign(np.array([5, 8, 3, 4, 4]), 8, 1.0, 1.0)
    assert [(p, b, n) for p, b, n, _, _ in parts][:3] == [(1, 0, 8), (0, 0, 5), (3, 0, 4)]
    assert sorted((s, o, n) for _, _, n, s, o in parts if s == 2) == [(2, 0, 4), (2, 4, 4)]
    assert packing.assign(np.zeros(0, int), 8, 1.0, 1.0) == []


def test_packing_an_empty_table(spark):
    assert packing.pack(none(spark), vocabulary()).count() == 0


def test_op6_query(spark, sf_dir, tokenizer):
    rows = QUERIES["op6_cost_packing"](spark, sf_dir).collect()
    total = 0
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        wanted = encoded(tokenizer, r["text"], 1)
        total += len(wanted)
        for p in [p for p in rows if p["doc_id"] == r["doc_id"]]:
            assert p["ids_crc32"] == crc32(wanted[p["start"] : p["start"] + p["length"]].tobytes())
    assert sum(r["length"] for r in rows) == total
    assert total / (2048 * len({r["sequence_id"] for r in rows})) > 0.97


def greedy(text, vocabulary_set):
    longest, total, unknown = max(map(len, vocabulary_set)), 0, 0
    for word in text.split():
        at, n = 0, 0
        while at < len(word):
            size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in vocabulary_set), 0)
            if not size:
                break
            at, n = at + size, n + 1
        unknown += at < len(word)
        total += n if at == len(word) else 1
    return len(text.split()), total, unknown


@pytest.mark.parametrize("seed", range(6))
def test_automaton_counts_what_greedy_matching_cuts(seed):
    draw = np.random.default_rng(seed)
    words = ["".join(draw.choice(list("abc"), draw.integers(1, 6))) for _ in range(25)]
    known = set(words) | ({"a", "b", "c"} if seed % 2 else {"a"})
    made = pieces.PieceCounter(sorted(known))
    for _ in range(400):
        word = "".join(draw.choice(list("abc"), draw.integers(1, 14)))
        _, total, unknown = greedy(word, known)
        assert made.count(word) == (None if unknown else total), word


def test_piece_counts_of_awkward_texts(spark):
    df = documents(spark, [(60, "Ünïcode 漢字 x\x85y " + "z" * 300, None, None, None)]).withColumn("Counts", F.lit(1))
    letters = ids.byte_letters()
    import json

    known = set(pieces.vocabulary_pieces(json.load(open(vocabulary()))["model"]["vocab"]))
    made = pieces.count_tokens(df, "text", vocabulary())
    assert made.columns[-1] == "counts" and "Counts" not in made.columns
    rows = made.collect()
    assert len(rows) == df.count()
    for r in rows:
        blank = (r["text"] or "").translate({ord(c): " " for c in "\t\n\r\f\v"})
        mapped = " ".join("".join(letters[b] for b in w.lower().encode()) for w in blank.split(" ") if w)
        assert tuple(r["counts"]) == greedy(mapped, known)
    assert pieces.count_tokens(none(spark), "text", vocabulary()).count() == 0


def greedy_to_the_end(word, vocabulary):
    """Pieces of a word if only a piece with the mark of a word's end may end it."""
    at, n = 0, 0
    while at < len(word):
        if word[at:] + "</w>" in vocabulary:
            return n + 1
        at = next((k for k in range(len(word) - 1, at, -1) if word[at:k] in vocabulary), None)
        n += 1
        if at is None:
            return None
    return None


@pytest.mark.parametrize("seed", range(6))
def test_pieces_that_end_a_word_fit_only_there(seed):
    draw = np.random.default_rng(seed)
    known = {"".join(draw.choice(list("abc"), draw.integers(1, 6))) + draw.choice(["", "</w>"]) for _ in range(40)}
    known |= {"a", "b", "c"} if seed % 2 else set()
    made = pieces.PieceCounter(sorted(pieces.ending_pieces(known)))
    for _ in range(400):
        word = "".join(draw.choice(list("abc"), draw.integers(1, 14)))
        assert made.count(pieces.last_marked(word)) == greedy_to_the_end(word, known), word


def test_op8_counts_pieces_up_to_marked_ends(spark):
    df = documents(spark, [(61, "Ünïcode 漢字 rendous rendousx I " + "z" * 300, None, None, None)])
    letters = ids.byte_letters()
    import json

    known = set(json.load(open(vocabulary()))["model"]["vocab"])
    for r in pieces.count_tokens(df, "text", vocabulary(), word_ends=True).collect():
        words = [w for w in (r["text"] or "").translate({ord(c): " " for c in "\t\n\r\f\v"}).split(" ") if w]
        counts = [greedy_to_the_end("".join(letters[b] for b in w.lower().encode()), known) for w in words]
        assert tuple(r["counts"]) == (len(words), sum(1 if n is None else n for n in counts), counts.count(None))


def test_marks_are_ignored_where_a_vocabulary_has_none(tmp_path):
    path = tmp_path / "plain.json"
    path.write_text('{"model": {"vocab": {"a": 0, "ab": 1}}}')
    counter, _, marked = pieces.counter(str(path), True)
    assert not marked and counter.count("aba") == 2


def test_op8_query(spark, sf_dir):
    rows = QUERIES["op8_greedy_pieces"](spark, sf_dir).collect()
    given = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} == set(given)
    assert all(r["n_tokens"] >= r["n_words"] == len(given[r["doc_id"]].split()) for r in rows)
    assert prose(1, 5)
