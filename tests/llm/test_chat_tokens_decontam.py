import json
import random

import pytest

from skyledger.llm import chat, decontam, tokens
from skyledger.llm import text as tx

SF = "/root/testdata/sf0.01"
SCHEMAS = {"find": {"q": {"type": "string", "required": True, "min_length": 2}, "n": {"type": "integer"},
                    "kind": {"type": "string", "enum": ["a", "b"]}, "deep": {"type": "object"}}}


def _link(spark, calls, results):
    c = spark.createDataFrame(calls, "conv_id long, call_id string, name string, arguments string, after string")
    r = spark.createDataFrame(results, "conv_id long, call_id string, content string")
    out = chat.link_tool_calls(c, r, SCHEMAS).collect()
    return {(x["conv_id"], x["call_id"]): x for x in out}, out


def test_link_order_validate(spark):
    got, out = _link(spark, [
        (1, "a", "find", '{"q":"xy","n":3}', None), (1, "b", "find", '{"q":"x","n":"3"}', "a"), (1, "c", "find", "nope", "b"),
        (1, "d", "other", "{}", "gone"), (1, "e", "find", '{"q":"zz","kind":"c","odd":1,"n":null}', "f"), (1, "f", "find", '{"n":1}', "e"),
        (2, "a", "find", '{"q":"\\"é\\n","deep":{"z":1,"a":[2,{"y":1,"b":2}]}}', None), (None, "x", "find", "[]", None),
        (3, "t", "find", '{"q":"same"}', None), (3, "t", "find", '{"q":"same"}', None)],
        [(1, "a", 'said "so"'), (1, "b", "one"), (1, "b", "two"), (2, "zz", None), (None, "x", "lost"), (3, "t", "ok")])
    assert [got[1, k]["depth"] for k in "abcdef"] == [0, 1, 2, 0, None, None]
    assert [got[1, k]["status"] for k in "abcd"] == ["linked", "ambiguous", "unanswered", "unanswered"]
    assert got[1, "a"]["valid"] and got[1, "a"]["errors"] == []
    assert got[1, "b"]["errors"] == ["n: not integer", "q: too short"]
    assert got[1, "c"]["errors"] == ["not JSON", ] and got[1, "d"]["errors"] == ["unknown tool"]
    assert got[1, "e"]["errors"] == ["kind: not allowed", "odd: unexpected"] and got[1, "f"]["errors"] == ["q: missing"]
    assert got[2, "zz"]["status"] == "stray" and got[3, "t"]["n_calls"] == 2
    assert sorted(x["status"] for x in out if x["conv_id"] is None) == ["stray", "unanswered"]
    text = got[2, "a"]["json"]
    assert '"arguments":{"deep":{"a":[2,{"b":2,"y":1}],"z":1},"q":"\\"é\\n"}' in text
    for x in out:
        json.loads(x["json"])
    assert json.loads(got[1, "a"]["json"])["content"] == 'said "so"'


def test_no_call_or_result_is_lost(spark):
    """Different calls or results of one id, and rows without identifier, keep rows of their own."""
    _, out = _link(spark, [
        (1, "a", "find", '{"q":"one"}', None), (1, "a", "find", '{"q":"two"}', None), (1, "a", "find", '{"q":"two"}', None),
        (1, None, "find", '{"q":"lone"}', None), (1, None, "find", '{"q":"lone"}', None), (None, "a", "find", '{"q":"nil"}', None),
        (1, "b", "find", '{"q":"bee"}', "a"), (1, "c", "find", '{"q":"sea"}', None)],
        [(1, "a", "first"), (1, "b", "x"), (1, "b", None), (1, "b", "y"), (1, None, "lost"), (1, None, "lost too"), (2, "z", "s"), (2, "z", "t")])
    told = [(str(x["conv_id"]), str(x["call_id"]), x["status"], x["n_calls"], x["n_results"], str(x["depth"]),
                   json.loads(x["json"]).get("call", {}).get("arguments", {}).get("q"), json.loads(x["json"]).get("content")) for x in out]
    assert sorted(told, key=str) == sorted([
        ("1", "a", "linked", 3, 1, "0", "one", "first"), ("1", "a", "linked", 3, 1, "0", "two", "first"),
        ("1", "b", "ambiguous", 1, 3, "1", "bee", None), ("1", "b", "ambiguous", 1, 3, "1", "bee", "x"), ("1", "b", "ambiguous", 1, 3, "1", "bee", "y"),
        ("1", "c", "unanswered", 1, 0, "0", "sea", None), ("2", "z", "stray", 0, 2, "None", None, "s"), ("2", "z", "stray", 0, 2, "None", None, "t"),
        ("1", "None", "unanswered", 1, 0, "None", "lone", None), ("1", "None", "unanswered", 1, 0, "None", "lone", None),
        ("None", "a", "unanswered", 1, 0, "None", "nil", None),
        ("1", "None", "stray", 0, 1, "None", None, "lost"), ("1", "None", "stray", 0, 1, "None", None, "lost too")], key=str)


def test_long_chain_and_empty(spark):
    n = 300
    ids = list(range(n))
    random.Random(2).shuffle(ids)
    got, _ = _link(spark, [(7, f"k{i}", "find", '{"q":"ok"}', f"k{i - 1}" if i else None) for i in ids], [])
    assert all(got[7, f"k{i}"]["depth"] == i for i in range(n))
    assert _link(spark, [], [])[1] == []


def test_every_message_is_linked_or_named(spark):
    m = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = m.collect()
    out = chat.link_tool_calls(*chat.turns_as_calls(m), chat.CHAT_TOOLS).collect()
    asked = {(r["conv_id"], r["turn"]): r for r in rows if r["role"] in ("user", "system")}
    said = {(r["conv_id"], r["turn"] - 1): r for r in rows if r["role"] == "assistant"}
    assert len(out) == len(asked.keys() | said.keys())
    for r in out:
        key = (r["conv_id"], int(r["call_id"].split("-")[-1]))
        body = json.loads(r["json"])
        assert (r["status"] == "stray") == (key not in asked)
        if key in asked:
            args = {"prompt": asked[key]["text"], "turn": key[1]}
            assert body["call"]["arguments"] == args
            assert json.dumps(args, sort_keys=True, separators=(",", ":"), ensure_ascii=False) in r["json"]
        if key in said:
            assert body["content"] == said[key]["text"]


# ---- tokens

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    return tokens.load(public_tokenizers.path("word_bpe_49k.json"))


def test_splicing_equals_encoding_whole(tokenizer):
    r = random.Random(4)
    parts = ["the", "It's", "don't", "naïve", "e\u0301te\u0301", "<|endoftext|>", "12345", "!!!", "ÀÉÎ", "\u00a0", "日本語", "x" * 70, "a'll", "ΑΣ"]
    for n in range(25):
        text = "".join(r.choice(parts) + r.choice([" ", "", "\n", "\t ", " "]) for _ in range(400))
        whole = len(tokenizer.encode(text, add_special_tokens=False).ids)
        for chunk, overlap in ((40, 10), (100, 30), (333, 50)):
            assert tokens.count_spliced(tokenizer, text, chunk, overlap) == whole
    solid = "abc123" * 400  # no white space: the overlap widens to the start
    assert tokens.count_spliced(tokenizer, solid, 100, 20) == len(tokenizer.encode(solid, add_special_tokens=False).ids)


def test_token_counts(spark, docs_of, tokenizer, monkeypatch):
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()]
    rows += [(9001, None), (9002, ""), (None, "<|startoftext|> hi"), (9003, "lorem ipsum " * 30000), (9003, "x")]
    out = tokens.token_counts(docs_of(rows), path).collect()
    want = sorted((i is None, i or 0, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in out) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in out)
    assert tokens.token_counts(docs_of([]), path).collect() == []


def test_remembered_pieces_equal_the_library(tokenizer, monkeypatch):
    """Random mixes of letters, signs, marks, special strings and all kinds of white space, with a small memory."""
    assert tokens.drops_white_space(tokenizer)
    r = random.Random(5)
    parts = ["the", "It's", "DON'T", "!'s", "''ll", "naïve", "e\u0301", "x\u0301", "=\u0338", "<|endoftext|>", "<|EndOfText|>", "<|", "endoftext|>", "12a3", "!!!",
             "ÀÉ", "日本", "a" * 70, "1." * 40, "b" * 99 + "." + "c" * 80, "ΑΣ", "İ", "K", "...", "«", "…", "\x1c", "\x85", "\x00", "ﬁ", "각", "\u1100\u1161", "\u11a8"]
    gaps = ["", "", "", " ", "\n", "\t", "\r\n", "\v", "\f", "\u00a0", "\u2028", "\u3000", "  "]
    texts = ["".join(r.choice(parts) + r.choice(gaps) for _ in range(r.randrange(0, 300))) for _ in range(150)]
    want = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    for limit in (10, 100_000):
        pieces = tokens.Pieces(tokenizer, limit)
        assert [n for at in range(0, 150, 7) for n in tokens.count_batch(tokenizer, texts[at:at + 7], pieces)] == want
        assert all(len(p) <= tokens.LONGEST_PIECE for p in [*pieces.pieces, *pieces.parts])
    monkeypatch.setattr(tokens, "CHUNK", 40)        # parts are learnt in many small texts; long texts are spliced
    assert tokens.count_batch(tokenizer, texts, tokens.Pieces(tokenizer)) == want


def test_white_space_is_kept_by_other_vocabularies():
    import public_tokenizers
    assert not tokens.drops_white_space(tokens.load(public_tokenizers.path("byte_bpe_50k.json")))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_splicing_without_white_space(name):
    import public_tokenizers
    tokenizer = tokens.load(public_tokenizers.path(name))
    r = random.Random(8)
    parts = ["日本語", "。", "abc", "1", "'s", "!'", "e\u0301", "\u0301", "\u1100", "\u1161", "\u11a8", "ক", "\u09c7", "\u09be", "—", "  ", "\u3000"]
    for _ in range(20):
        text = "".join(r.choice(parts) for _ in range(400))
        whole = len(tokenizer.encode(text, add_special_tokens=False).ids)
        for chunk, overlap in ((30, 4), (100, 30), (500, 50)):
            assert tokens.count_spliced(tokenizer, text, chunk, overlap) == whole
    endless = "語" * 5000
    assert tokens.count_spliced(tokenizer, endless, 100, 20) == len(tokenizer.encode(endless, add_special_tokens=False).ids)


def test_sentencepiece_counts(spark, docs_of):
    import public_tokenizers
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = tokens.load(path)
    rows = [(1, "Hello  wörld"), (2, None), (3, "a" * 3000)]
    assert {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(docs_of(rows), path).collect()} == {
        i: len(model.encode(t or "")) for i, t in rows}


# ---- decontamination

def _plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            keep = row[j]
            row[j] = last + 1 if x == y else max(row[j], row[j - 1])
            last = keep
    return row[-1]


def test_lcs_equals_dynamic_programming():
    r = random.Random(0)
    for _ in range(200):
        a, b = ([bytes([97 + r.randint(0, 5)]) for _ in range(r.randint(1, 40))] for _ in range(2))
        assert decontam.lcs_length(a, b) == _plain_lcs(a, b)


def test_leaks_equal_brute_force(spark):
    """Every document that holds an item's words, and no other; recall against brute force is 1."""
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r["item_id"], b" ".join(tx.label_words(r["text"]))) for r in bench.collect()]
    want = {(r["doc_id"], i) for r in docs.collect() for i, w in items
            if b" " + w + b" " in b" " + b" ".join(tx.label_words(r["text"])) + b" "}
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}
    assert len(want) > 5 and want <= got and {d for d, _ in got} == {d for d, _ in want}


def test_paraphrases_and_odd_rows(spark, docs_of):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()
    words = item["text"].split()
    edited = " ".join(w if k % 6 else "changed" for k, w in enumerate(words))
    filler = " ".join(f"fill{k}" for k in range(300))
    d = docs_of([(1, filler + " " + edited + " " + filler), (2, filler), (3, None), (4, ""), (None, item["text"]), (5, item["text"].upper()), (5, item["text"])])
    bench = spark.createDataFrame([(item["item_id"], item["text"]), (77, None), (78, ""), (None, "x y z")], "item_id long, text string")
    found = decontam.contaminated(d, bench).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "5", "5", "None"]
    assert all(r["item_id"] == item["item_id"] for r in found)
    kept = decontam.keep_clean(d, bench)
    assert kept.columns == d.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "4", "None"]
    assert decontam.contaminated(docs_of([]), bench).collect() == []
    assert decontam.contaminated(d, bench.limit(0)).collect() == []


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    key = lambda f: sorted((r["doc_id"], r["item_id"]) for r in f.collect())
    whole = key(decontam.contaminated(docs, bench))
    monkeypatch.setattr(decontam, "ITEMS_PER_PASS", 15)
    assert key(decontam.contaminated(docs, bench)) == whole
    monkeypatch.setattr(decontam, "ITEMS_PER_PASS", 2_000)
    monkeypatch.setattr(decontam, "BYTES_PER_PASS", 4_000)
    assert key(decontam.contaminated(docs, bench)) == whole


def test_many_texts_of_one_item(spark, docs_of, monkeypatch):
    """Texts that share an item id are all searched, also where they fall in different blocks."""
    texts = [" ".join(f"w{k}x{j}" for j in range(20)) for k in range(7)]
    d = docs_of([(k, t) for k, t in enumerate(texts)])
    bench = spark.createDataFrame([(1, t) for t in texts], "item_id long, text string")
    monkeypatch.setattr(decontam, "ITEMS_PER_PASS", 3)
    assert sorted(r["doc_id"] for r in decontam.contaminated(d, bench).collect()) == list(range(7))


def _verbatim(docs, items):
    return {(d, i) for d, t in docs for i, w in items
            if b" " + b" ".join(tx.label_words(w)) + b" " in b" " + b" ".join(tx.label_words(t)) + b" "}


def _pass_of_items(docs, n, words, seed=3):
    """``n`` passages of so many words, cut from the documents."""
    r = random.Random(seed)
    long = [w for w in (t.split() for _, t in docs if t) if len(w) >= words]
    at = [(w, r.randrange(len(w) - words + 1)) for w in r.choices(long, k=n)]
    return [(k, " ".join(w[a:a + words])) for k, (w, a) in enumerate(at)]


def test_copies_of_a_full_pass_of_items_are_found(spark):
    """Recall against brute force is 1 with as many items as one pass takes."""
    table = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(300)
    docs = [(r["doc_id"], r["text"]) for r in table.collect()]
    items = _pass_of_items(docs, decontam.ITEMS_PER_PASS, 20)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = _verbatim(docs, items)
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(table, bench).collect()}
    assert len(want) >= len(items) and want <= got


def test_copy_amid_rare_words(spark, docs_of):
    """Words that no other text has weigh most, but don't hide an item of common words."""
    item = " ".join(f"common{k}" for k in range(12))
    other = [(k, f"{item} {k}") for k in range(100, 300)]
    rare = [(k, " ".join(f"r{k}x{j}" for j in range(40)) + " " + item + " " + " ".join(f"s{k}x{j}" for j in range(40))) for k in range(20)]
    d = docs_of(rare + other)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r["doc_id"] for r in decontam.contaminated(d, bench).collect()} == {k for k, _ in rare + other}


def test_long_items_are_found(spark, docs_of):
    """An item of many passages, copied whole; a part of it alone is no copy."""
    source = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(400).collect()]
    items = _pass_of_items([(d, t) for d, t in source if t and 300 <= len(tx.label_words(t)) < 2_000], 5, 300)
    filler = " ".join(f"fill{k}" for k in range(100))
    copies = [(k, f"{filler} {t} {filler}") for k, t in items]
    parts = [(100 + k, f"{filler} {' '.join(t.split()[40:120])} {filler}") for k, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontam.contaminated(docs_of(copies + parts), bench).collect()
    assert _verbatim(copies, items) <= {(r["doc_id"], r["item_id"]) for r in out}
    assert all(r["lcs_ratio"] == 1 and r["answer"] for r in out if r["doc_id"] == r["item_id"])
    assert all(r["doc_id"] < 100 for r in out)


def test_clean_rows_stay_beside_contaminated_ones_of_their_id(spark, docs_of):
    item = " ".join(f"common{k}" for k in range(12))
    other = " ".join(f"fill{k}" for k in range(40))
    d = docs_of([(1, item), (1, other), (2, other), (2, f"{other} {item}")])
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    kept = decontam.keep_clean(d, bench)
    assert kept.columns == d.columns and sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, other), (2, other)]


def test_items_without_id_are_searched(spark, docs_of, monkeypatch):
    texts = [" ".join(f"w{k}x{j}" for j in range(20)) for k in range(4)]
    d = docs_of([(k, t) for k, t in enumerate(texts)])
    bench = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (2 ** 60 + 1, texts[2])], "item_id long, text string")
    for n in (2_000, 1):
        monkeypatch.setattr(decontam, "ITEMS_PER_PASS", n)
        found = sorted((r["doc_id"], r["item_id"]) for r in decontam.contaminated(d, bench).collect())
        assert found == [(0, None), (1, None), (2, 2 ** 60 + 1)]
    assert [r["doc_id"] for r in decontam.keep_clean(d, bench).collect()] == [3]


def test_space_is_fitted_on_all_documents(spark, docs_of, monkeypatch):
    """Weights and products of every text's passages, summed in a square or part by part; the last of 900 texts counts."""
    import numpy as np
    texts = [" ".join(f"w{(k * 7 + j * (1 + k % 3)) % 90}" for j in range(k % 61)) for k in range(899)] + ["only here a pair " * 9]
    items = [(k, tx.label_words(f"w{3 * k} w{3 * k + 1} w{k} only here w{k + 5} a pair")) for k in range(20)]
    space = decontam.Space(items)
    numbered = docs_of([*enumerate(texts), (-1, None)]).selectExpr("cast(doc_id as string) doc_id", "text").mapInPandas(
        decontam._numbered(space), "doc_id string, ids binary")
    decontam.fit_space(space, numbered)
    right = np.random.default_rng(0).standard_normal((len(space.vocab), 5))
    want = np.zeros(right.shape)
    for t in texts:
        ids = space.ids(tx.label_words(t))
        for s in decontam._windows(len(ids)):
            at, v = space.rows(ids[s:s + decontam.WINDOW])
            want[at] += np.outer(v, v @ right[at])
    for square in (decontam.SQUARE, 1):
        monkeypatch.setattr(decontam, "SQUARE", square)
        sums = decontam._Products(space, right)
        for words in decontam._joined(decontam._passages([space.ids(tx.label_words(t)) for t in texts])):
            sums.add(words)
        assert np.allclose(sums.total(), want, atol=1e-3)
    # Eigenvectors of all passages' product, not of a part of them: the square of all spans the basis.
    whole = np.zeros((len(space.vocab),) * 2)
    for ids in [space.ids(ws) for _, ws in space.parts] + [space.ids(tx.label_words(t))[s:s + decontam.WINDOW]
                                                           for t in texts for s in decontam._windows(len(tx.label_words(t)))]:
        at, v = space.rows(ids)
        whole[np.ix_(at, at)] += np.outer(v, v)
    inside = space.basis.T.astype(float) @ whole @ space.basis
    assert np.allclose(np.linalg.eigvalsh(inside)[-10:], np.linalg.eigvalsh(whole)[-10:], rtol=1e-3)


def test_one_pass_serves_both_iterations(spark, docs_of, monkeypatch):
    """The square of all passages is summed once, over all partitions, and spans the basis; passages aren't multiplied again."""
    import numpy as np
    texts = [" ".join(f"w{(k * 7 + j * (1 + k % 3)) % 90}" for j in range(k % 61)) for k in range(400)]
    items = [(k, tx.label_words(" ".join(f"w{(5 * k + j) % 97}" for j in range(9)))) for k in range(30)]
    space = decontam.Space(items)
    monkeypatch.setattr(decontam, "_product", None)
    numbered = docs_of([*enumerate(texts)]).selectExpr("cast(doc_id as string) doc_id", "text").repartition(3).mapInPandas(
        decontam._numbered(space), "doc_id string, ids binary")
    decontam.fit_space(space, numbered, rank=20)
    whole = np.zeros((len(space.vocab),) * 2)
    for ids in [space.ids(ws) for _, ws in space.parts] + [space.ids(tx.label_words(t))[s:s + decontam.WINDOW]
                                                           for t in texts for s in decontam._windows(len(tx.label_words(t)))]:
        at, v = space.rows(ids)
        whole[np.ix_(at, at)] += np.outer(v, v)
    assert len(space.vocab) > decontam.ROWS
    inside = space.basis.T.astype(float) @ whole @ space.basis
    assert np.allclose(np.linalg.eigvalsh(inside)[-3:], np.linalg.eigvalsh(whole)[-3:], rtol=1e-2)


def test_texts_searched_together_stay_apart():
    """A copy cut by a text's end isn't completed by the next text's words; places are those of the own text."""
    import numpy as np
    import pandas as pd
    words = [f"b{k}" for k in range(20)]
    space = decontam.Space([(7, tx.label_words(" ".join(words)))])
    space.weigh(np.ones(len(space.vocab)), 9)
    own = [space.rows(space.ids(ws)) for _, ws in space.parts]
    space.index(own)
    space.basis = np.eye(len(space.vocab), dtype=np.float32)
    space.vectors = np.stack([np.bincount(at, v, len(space.vocab)).astype(np.float32) for at, v in own])
    texts = ["", " ".join(["other"] * 40 + words[:8]), " ".join(words[12:]), "", " ".join(["x"] * 50 + words), " ".join(words), ""]
    together = pd.DataFrame({"doc_id": list("abcdefg"), "ids": [space.ids(tx.label_words(t)).tobytes() for t in texts]})
    search = decontam._search(space, decontam.LEAST_COSINE)
    got = next(search([together]))
    apart = pd.concat(search([together[k:k + 1] for k in range(len(together))]))
    assert got.to_dict("records") == apart.to_dict("records") and list(got["doc_id"]) == ["e", "f"]
    assert list(got["at_word"]) == [48, 0] and list(got["lcs"]) == [20, 20]
