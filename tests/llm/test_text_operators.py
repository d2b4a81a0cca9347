"""Text operators against plain Python on rows with every kind of trouble."""

import random
from itertools import combinations

import brute
import pytest
from pyspark.sql import functions as F

from marketpulse.llm import (decontaminate, jaccard_join, line_dedup, merkle, sentence_pieces,
                             substring_dedup, token_files)


def tokenizer(name):
    return pytest.importorskip("public_tokenizers").path(name)


def test_substring_dedup(trouble, pairs):
    for size in (3, 20):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept)
               for r in substring_dedup.remove_repeats(trouble, size).collect()}
        assert got == brute.substring_dedup(pairs, size)


def test_substring_dedup_gives_maximal_intervals(spark):
    d = spark.createDataFrame([(1, "a b c d e"), (2, "x a b c d y b c d e")], "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.removed] for r in substring_dedup.remove_repeats(d, 3).collect()}
    assert got == {1: [], 2: [(1, 5), (6, 10)]}


def test_line_dedup(trouble, pairs):
    for run in (2, 3):
        got = {r.doc_id: (r.n_lines, r.n_removed, r.kept)
               for r in line_dedup.dedup_lines(trouble, run).collect()}
        assert got == brute.line_dedup(pairs, run)


def test_line_dedup_extends_matches_both_ways(spark):
    lines = [f"line {k}" for k in range(12)]
    d = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(["new", *lines[2:9], "more"]))],
                              "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(d, 3).collect()}
    assert [tuple(x) for x in got[2].runs] == [(1, 8, 1, 2)] and got[2].kept == "new\nmore"
    assert got[1].runs is None and got[1].n_removed == 0


def test_line_dedup_finds_a_context_that_is_not_the_first(spark):
    texts = ["x\nA\ny", "p\nA\nq", "n\np\nA\nq\nm"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.kept for r in line_dedup.dedup_lines(d, 2).collect()}
    assert got[2] == "n\nm" and got[1] == texts[1]


def test_jaccard_components(trouble, pairs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(trouble).collect()}
    assert got == brute.components(pairs)


def test_jaccard_on_dense_lists(spark):
    """Large groups of near copies around each other, linked only through some."""
    import random
    rng = random.Random(3)
    core = [f"c{k}" for k in range(80)]
    rows = []
    for k in range(70):
        w = list(core)
        for x in rng.sample(range(80), rng.choice([0, 1, 1, 2, 2, 3])):
            w[x] = f"own{k}x{x}"
        rows.append((k, " ".join(w)))
    for k in range(70, 130):   # short sets around the boundary
        w = [f"s{x}" for x in range(rng.choice([4, 5, 6, 8, 9, 10, 11]))]
        if rng.random() < 0.5:
            w.append(f"t{k % 3}")
        rows.append((k, " ".join(w)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(d).collect()}
    assert got == brute.components(rows)


def test_jaccard_exact_copies_in_any_order(spark):
    """Exact copies inside a large group of near copies, larger ids first."""
    core = [f"c{k}" for k in range(80)]
    rows = [(k, " ".join([*core[:k], f"own{k}", *core[k + 1:]])) for k in range(10, 40)]
    rows += [(k, " ".join([*core[:60], "same", *core[61:]])) for k in (3, 50, 51)]
    rows += [(k, f"{' '.join(core)} tail") for k in (2, 60)]
    d = spark.createDataFrame(rows[::-1], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(d).collect()}
    assert got == brute.components(rows)


def test_jaccard_with_other_shingles_and_threshold(spark, trouble, pairs):
    import random
    rng = random.Random(8)
    rows = [(i, t) for i, t in pairs]
    for g in range(6):
        core = [f"g{g}w{k}" for k in range(100)]
        for k in range(24):
            tail = [f"t{g}x{k}y{x}" for x in range(rng.choice([0, 5, 12, 20, 23, 24, 25, 30]))]
            rows.append((1000 + 100 * g + k, " ".join(core + tail)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.near_duplicates(d, 5, 80, 100).collect()}
    assert got == brute_components(rows, 5, 80)


def brute_components(rows, k, num):
    sets = [(i, brute.shingles(t, k)) for i, t in brute.by_id(rows)]
    top = {i: i for i, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= num * len(x | y):
            low, high = sorted((find(a), find(b)), key=lambda v: (v is not None, v or 0))
            if low != high:
                top[high] = low
    return {i: (len(s), find(i)) for i, s in sets}


def test_jaccard_bounds():
    for a in range(1, 60):
        for b in range(a, 60):
            o = jaccard_join.overlap(a, b)
            linked = 100 * o >= 85 * (a + b - o)
            assert linked and 100 * (o - 1) < 85 * (a + b - o + 1)
            if o <= a:   # linked sets share one of their first ones
                assert o > a - jaccard_join.prefix(a) and o > b - jaccard_join.prefix(b)
    assert jaccard_join.boundary(0.0) >= 6
    assert jaccard_join.boundary(50.0) > jaccard_join.boundary(0.0)


def test_small_sets_by_subsets(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "boundary", lambda scan: 14)
    rows = [(k, " ".join(f"s{x}" for x in range(4 + k % 14)) + (f" e{k % 4}" if k % 3 else ""))
            for k in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(d).collect()}
    assert got == brute.components(rows)


def test_contamination(spark, trouble, pairs):
    items = [(1, "Seven wizards, QUIETLY mix potent brews beside nineteen glowing lanterns near an old river"),
             (2, "tiny"), (3, None), (4, ""), (5, "nothing of this occurs in any document at all, not even once"),
             (2, "a b c"), (None, "second line here third line here fourth line here"), (30, "again " * 12)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    want = brute.contamination(pairs, items)
    for block_bytes in (1, 1 << 20):   # a block for each item, one block
        got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids)
               for r in decontaminate.contamination(trouble, bench, block_bytes=block_bytes).collect()}
        assert got == want


def test_longest_matches_have_locations(spark):
    d = spark.createDataFrame([(1, "zz one two three four five yy one two three")], "doc_id long, text string")
    b = spark.createDataFrame([(9, "aa one two three four bb")], "item_id long, text string")
    row = decontaminate.longest_matches(d, b, size=3).first()
    assert sorted(tuple(m) for m in row.matches) == [("9", 1, 1, 4), ("9", 1, 7, 3)]


def test_suffix_array_is_in_order():
    import numpy as np
    rng = np.random.default_rng(1)
    seq = rng.integers(0, 4, 400)
    array = decontaminate.SuffixArray(seq, 2, 400)
    keys = [tuple(seq[a:]) for a in array.at]
    assert keys == sorted(keys) and len(keys) == np.count_nonzero(seq)


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert decontaminate.contamination(empty, bench).count() == 0
    assert merkle.edit_fingerprints(empty).count() == 0
    assert merkle.fingerprints(empty).count() == 0
    assert token_files.read_documents(token_files.write(empty, tokenizer("word_bpe_49k.json"))).count() == 0
    assert sentence_pieces.encode(empty, tokenizer("piece_bpe_32k.model")).count() == 0


def test_no_benchmark_hits_nothing(spark, trouble):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(trouble, bench).filter("n_hit > 0").count() == 0


def test_fingerprints(trouble, pairs):
    docs = brute.by_id(pairs)[::-1]
    got = {r.doc_id: r for r in merkle.edit_fingerprints(trouble).collect()}
    assert len(got) == len(docs)
    for k, (i, t) in enumerate(docs):
        t, after = t or "", docs[(k + 1) % len(docs)][1] or ""
        n = len(t) // 3
        edited = t[: len(t) - n] + after[:n]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), brute.sha(edited))
        assert r.fingerprint == merkle.fingerprint(t) and r.edited_fingerprint == merkle.fingerprint(edited)
        assert r.near_edited == pytest.approx(brute.merkle_likeness(t, edited))
        assert r.near_next == pytest.approx(brute.merkle_likeness(t, after))
    prints = {merkle.fingerprint(t or "") for _, t in docs}
    assert len(prints) == len({t or "" for _, t in docs})
    one = trouble.filter("doc_id = 9").select("doc_id", F.lit("only one document").alias("text")).limit(1)
    assert merkle.edit_fingerprints(one).first().n_chars == 17


def _unspaced():
    rnd = random.Random(8)
    yield "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(660))
    yield "".join(chr(rnd.randrange(0x4e00, 0x4e80)) for _ in range(2000))
    yield "".join(chr(rnd.randrange(0x1f300, 0x1f500)) for _ in range(900))
    yield " ".join("".join(chr(rnd.randrange(0xe01, 0xe2f)) for _ in range(rnd.randrange(30, 90))) for _ in range(40))


def test_likeness_of_unspaced_text():
    """Two thirds kept is about two thirds, in any script."""
    for text in _unspaced():
        own = merkle.fingerprint(text)
        leaves = [leaf for line in text.splitlines(keepends=True) for leaf in merkle.leaves(line)]
        assert "".join(leaves) == text and max(len(x.encode()) for x in leaves) <= 240
        assert leaves == [leaf for p in brute.merkle_leaves(text) for leaf in p]
        n = len(text) // 3
        edited = text[: len(text) - n] + text[0] * n      # as many bytes a character
        near = merkle.likeness(own, merkle.fingerprint(edited))
        assert 0.55 <= near <= 0.75 and near == pytest.approx(brute.merkle_likeness(text, edited))
        assert merkle.likeness(own, merkle.fingerprint("\u0416" * len(text))) == 0
    # a run of one character has no cuts but by length; equal leaves are counted as often as they occur
    same = merkle.likeness(merkle.fingerprint("a" * 3000), merkle.fingerprint("a" * 2000))
    assert 0.6 <= same <= 0.7


def test_merkle_locates_edits():
    text = "\n".join(f"Paragraph {k} has some words. And a second sentence {k}." for k in range(40))
    edited = text.replace("words. And a second sentence 17", "changed words. And a second sentence 17")
    found = merkle.differences(merkle.fingerprint(text), merkle.fingerprint(edited))
    assert len(found) == 1 and merkle.differences(merkle.fingerprint(text), merkle.fingerprint(text)) == []
    assert merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(edited)) > 0.95
    assert "".join(merkle.leaves(text)) == text


def test_token_files(spark, trouble, pairs):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer
    path = tokenizer("word_bpe_49k.json")
    extra = [(100, "a <|endoftext|> b"), (101, "control\x1cseparated\x1fwords"), (102, "é ́x ΑΣ Σ İ")]
    docs = trouble.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    manifest = token_files.write(docs, path, seq_len=64)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_documents(manifest).collect()}
    t, start, want = Tokenizer.from_file(path), 0, {}
    for i, text in brute.by_id([*pairs, *extra]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want
    for r in manifest.collect():
        parts = list(token_files.read_sequences(r.path))
        assert all(ids.shape[1] == 64 and ids.shape == mask.shape for ids, mask in parts)
        assert sum(int(mask.sum()) for _, mask in parts) == r.n_ids
        _random_access(r.path, parts, dict(zip(r.doc_ids, r.lengths)), want)


def _random_access(path, parts, lengths, want):
    """Any sequence by its number, in any order, and any document by its place."""
    import zlib

    import numpy as np
    ids, mask = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    file = token_files.Sequences(path)
    assert len(file) == len(ids) and file.width == 64
    for k in random.Random(1).sample(range(len(ids)), min(len(ids), 300)):
        got, kept = file[k]
        assert (got == ids[k]).all() and kept.to_pylist() == mask[k].tolist()
        assert not got.flags.owndata and not got.flags.writeable     # a view of the mapped file
    start = 0
    for doc_id, n in lengths.items():
        one = file.span(start, n).astype("<u4")
        assert zlib.crc32(one.tobytes()) == next(w[2] for i, w in want.items() if (token_files.NULL_ID if i is None else i) == doc_id)
        start += n
    for wrong in (-1, len(file)):
        with pytest.raises(IndexError):
            file[wrong]
    file.close()


def test_random_access_at_batch_borders(spark):
    """Files of one sequence, of whole batches, and of a sequence more."""
    import numpy as np
    for n in (1, 63, 64, 65, 128, 129):
        writer = token_files._Writer(token_files._uri(spark, token_files.scratch_path(spark, "t-seq")), 0,
                                     np.dtype("<u2"), 8)
        ids = np.arange(n * 8 - 3, dtype="<u2")
        writer.add(ids)
        writer.close()
        file = token_files.Sequences(writer.path)
        assert len(file) == n and (file.span(0, len(ids)) == ids).all()
        assert file[n - 1][1].to_pylist() == [True] * 5 + [False] * 3 and len(file.span(3, 0)) == 0
        file.close()


def test_sentence_pieces(spark, trouble, pairs):
    path = tokenizer("piece_bpe_32k.model")
    model = sentence_pieces.Model.load(path)
    score = {p: (i, s) for p, i, s in model.pieces}
    want = {i: [x for w in sentence_pieces.words(t or "") for x in model.ids(
        brute.viterbi(w, score, model.unknown, model.longest))] for i, t in brute.by_id(pairs)}
    for hot in (sentence_pieces.HOT, 40, 0):   # all words hot, some, none
        out = sentence_pieces.encode(trouble, path, hot=hot)
        rows = sentence_pieces.decode(out, path).collect()
        assert {r.doc_id: r.ids for r in rows} == want
        assert all(r.round_trip for r in rows)
        assert {r.doc_id: r.decoded for r in rows} == {i: t or "" for i, t in brute.by_id(pairs)}


def test_lattices_are_folded_many_at_a_time(spark, monkeypatch):
    """No function is interpreted edge by edge; words of all lengths in one batch,
    batches of one Arrow batch each, and paths that tie."""
    import random
    rng = random.Random(7)
    pieces = [(p, i, -float(len(p))) for i, p in enumerate(("a", "b", "ab", "ba", "aab", "abab"))]   # every path ties
    ties = sentence_pieces.Model(pieces, [6] * 256, [p.encode() for p, _, _ in pieces] + [b"?"], -20.0)
    real = sentence_pieces.Model.load(tokenizer("piece_bpe_32k.model"))
    monkeypatch.setattr(sentence_pieces, "EDGES", 64)
    for model, letters in ((ties, "ab\u00e9"), (real, " international\u00e9\u6771")):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.choice((1, 2, 5, 9, 80)))) for _ in range(150)})
        vocab = spark.createDataFrame(list(enumerate(words)), "hash long, word string").repartition(2)
        out = sentence_pieces.fold(sentence_pieces.edges(vocab, model), model)
        assert "lambdafunction" not in out._jdf.queryExecution().optimizedPlan().toString()
        score = {p: (i, s) for p, i, s in model.pieces}
        got = {r.hash: r.codes for r in out.collect()}
        assert len(got) == len(words)
        for k, w in enumerate(words):
            path = model.ids(got[k])
            assert path == model.ids(brute.viterbi(w, score, model.unknown, model.longest)), w


def test_long_words_are_not_cut(spark):
    """Unspaced text and words of more than 64 characters, of more than 65,535 ids too."""
    import base64
    import random
    path = tokenizer("piece_bpe_32k.model")
    model = sentence_pieces.Model.load(path)
    score = {p: (i, s) for p, i, s in model.pieces}
    rng = random.Random(5)
    long = ["https://example.org/" + "international-information/" * 11, base64.b64encode(rng.randbytes(225)).decode(),
            "understanding" * 23, "東京都の天気は晴れです" * 28, "x" * 64, "y" * 65]
    best = {w: brute.viterbi(w, score, model.unknown, model.longest) for w in (" " + x for x in long)}
    cut = {w: [c for k in range(0, len(w), 64)
               for c in brute.viterbi(w[k: k + 64], score, model.unknown, model.longest)] for w in best}
    assert sum(best[w] != cut[w] for w in best) >= 3   # cuts would show
    rows = list(enumerate(long)) + [(90, "".join(rng.choice("東京都の天気") for _ in range(70_000)))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (sentence_pieces.HOT, 0):
        got = {r.doc_id: r for r in sentence_pieces.encode(d, path, hot=hot).collect()}
        assert all(r.round_trip for r in got.values()) and len(got[90].ids) > 65_535
        for i, x in enumerate(long):
            assert got[i].ids == model.ids(best[" " + x])
