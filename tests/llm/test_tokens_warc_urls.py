"""Token counts against the library, WARC round trips and damage, URL rules and terms."""

import gzip
import io
import random
import re

import duckdb
import pytest

from eventide.llm import tokens, urls, warc
from eventide.llm.catalogue import tokenizer_path

ALL = "extra string, n_tokens string, doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def whole(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False))


TEXTS = [
    None, "", " \n\t ", "Hello, world. It's don't WE'LL 3.50 a.b.c ...,,", "x" * 900, "é" * 300 + "́ ̈a",
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "naïve Straße ΣΑΣ İstanbul", "\x1c\x85 \xa0 zero\u200bwidth",
    "中文没有空格" * 40, "word, " * 300, "a\x0bb\x0cc\rd", "🙂🙂 é 🙂", "'s 's't n't", ".,.,!? \"q\".",
]


def test_token_counts_equal_the_library(spark, tokenizer):
    rng = random.Random(5)
    alphabet = "aAbéß ,.'\n1中 \t<|>"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 700))) for _ in range(60)]
    rows = [("e", "clash", i if i % 7 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, ALL)
    got = tokens.count_tokens(df, tokenizer_path(), chunk_chars=64, overlap_chars=4, limit=20).collect()
    want = sorted((len((t or "").encode()), whole(tokenizer, t)) for t in texts)
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 20) for r in got)
    assert tokens.count_tokens(df.limit(0), tokenizer_path()).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(40, 3), (64, 16), (200, 1)])
def test_chunks_are_spliced_exactly(tokenizer, chunk, overlap):
    def starts(part):
        return [a for a, _ in tokenizer.encode(part, add_special_tokens=False).offsets]

    rng = random.Random(chunk)
    for _ in range(40):
        n = rng.randint(0, 900)
        text = "".join(rng.choice("abcDé. 中'\n" + "z" * rng.choice((0, 40))) for _ in range(n))
        assert tokens.spliced_count(starts, text, chunk, overlap) == whole(tokenizer, text)
    assert tokens.spliced_count(starts, "q" * 1000, chunk, overlap) == whole(tokenizer, "q" * 1000)


def test_piece_memo_forgets_and_still_counts(tokenizer):
    memo = tokens.PieceMemo(tokenizer, size=3)
    for text in ["a b c d e", "e f, G. h", "a b, G i."]:
        memo.learn(set(text.encode().split()))
        assert sum(memo.new[p] for p in text.encode().split()) == whole(tokenizer, text)


def brute_warc(rows, least=0):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        holder = max(ids, default=None)
        same = sum((h or "").encode() == payload for _, _, h in rows)
        kind = "response" if same == 1 or len(payload) < least or holder is None or page == holder else "revisit"
        out.append((page, len(payload), warc.base32_sha1(payload), kind, holder if kind == "revisit" else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 4])
def test_warc_round_trip(spark, least):
    rows = [
        (1, "http://a/x y\r\nEvil: 1", "abc"), (2, None, "abc"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 100_000),
        (6, "u", "é" * 100_000), (6, "u", "é" * 100_000), (None, "u", "abc"), (None, "v", "only"), (9, "w", "a\r\n\r\nb"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    got = warc.warc_round_trip(df, min_revisit_bytes=least).collect()
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=str) == brute_warc(rows, least)
    assert warc.warc_round_trip(df.limit(0)).count() == 0


def test_warc_payloads_come_back_and_archives_roll(spark):
    df = spark.range(40).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "repeat(concat('p', id), 500) AS html")
    from eventide.llm.common import fresh_path

    manifest = warc.write_warc(df.coalesce(1), fresh_path(spark, "roll"), archive_bytes=400)
    assert manifest.count() > 3
    got = {r.record_id: bytes(r.payload).decode() for r in warc.read_warc(manifest, keep_payload=True).collect()}
    assert got == {f"urn:page:{i}": f"p{i}" * 500 for i in range(40)}
    with open(re.sub("^file:/+", "/", manifest.first().archive), "rb") as f:
        assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\n")  # any gzip reader reads it


def test_warc_damage_is_found():
    good = warc.record_bytes("response", 1, "u", b"hello", warc.base32_sha1(b"hello"), None, "d")
    many = warc.gzip_member(good) * 3
    assert [r.payload_length for r in warc.read_records(io.BytesIO(many), read_bytes=7)] == [5, 5, 5]
    bad = [
        many[:-9],
        warc.gzip_member(good.replace(b"hello", b"jello")),
        warc.gzip_member(good + b"more"),
        warc.gzip_member(good[:-3]),
        warc.gzip_member(good.replace(b"Content-Length: ", b"Content-Length: 9")),
        warc.gzip_member(b"nonsense\r\n\r\n"),
    ]
    for data in bad:
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(data)))


def test_urls_against_sql(spark):
    texts = [
        None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?q", "http://example.com/en/x", "http://com",
        "http://com/", "http://notcom/", "http://a.net/es/1", "http://a.net/es", "http://a.net/fr/?x=casino",
        "http://x.org/casino", "http://x.org/casinos", "http://x.org/free-bets", "http://x.org/free-win-free",
        "http://x.org/free/free", "http://u:p@h.org:80/p#casino", "a://b://net/es/", "http://x.org/ads/track",
        "http://É.org/spam-farm", "http://x.org/cheap\n-pills",
    ]
    rows = [(i, t, "c") for i, t in enumerate([*texts, *texts[:3]])]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = {tuple(r) for r in urls.judge_urls(df).collect()}
    pages = df.toPandas()  # noqa: F841 - DuckDB reads it by name
    names = ["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight"]
    want = duckdb.sql(f"SELECT {', '.join(names)} FROM ({urls.oracle('pages')})").fetchall()
    assert got == set(want) and len(got) == len(rows)
    by = {t: r for t, r in zip(texts, sorted(got, key=lambda r: r[0]), strict=False)}
    assert by["HTTP://WWW.Example.COM/en/x?q"][1:5] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert by["http://com"][3] is None and by["http://notcom/"][3] is None
    assert by["http://x.org/casino"][4] == "block" and by["http://x.org/casinos"][4] == "allow"
    assert by["http://x.org/free-bets"][4] == "block" and by["http://x.org/free/free"][4] == "allow"
    assert urls.judge_urls(df.limit(0)).count() == 0


def test_vocabulary_table(spark, tmp_path):
    """A vocabulary of some size from a file, against plain boundary checks."""
    rng = random.Random(6)
    stems = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 5))) for _ in range(4000)]
    rows = [(t if i % 9 else f" {t.upper()} ", None if i % 13 == 0 else rng.choice([0.5, 1.0, 1.5])) for i, t in enumerate(stems)]
    rows += [(None, 1.0), ("", None), ("free win", 1.0)]
    spark.createDataFrame(rows, "term string, weight double").write.parquet(str(tmp_path / "terms"))
    strict, soft = urls.vocabulary(spark.read.parquet(str(tmp_path / "terms")))
    low = [(t.strip().lower(), w) for t, w in rows if t]
    assert set(strict) == {t for t, w in low if w is None} and not set(strict) & set(soft)
    assert soft == {t: max(w for x, w in low if x == t) for t in {t for t, _ in low} - set(strict)}
    words = [*stems, "zzz", "page", "index"]
    texts = [f"http://{rng.choice(words)}.org/{rng.choice(words)}{rng.choice(['/', '-', 'x', '_', '%20'])}{rng.choice(words)}" for _ in range(500)]
    got = urls.judge_urls(spark.createDataFrame(list(enumerate(texts)), "page_id long, url string"), strict=strict, soft=soft, rules=[])
    seen = set()
    for r in got.collect():
        found = {t for t in {*strict, *soft} if re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", texts[r.page_id])}
        hard, light = found & set(strict), found & set(soft)
        weight = sum(soft[t] for t in light)
        assert (r.n_strict, r.n_soft, round(r.soft_weight, 6)) == (len(hard), len(light), round(weight, 6))
        assert r.verdict == ("block" if hard or (len(light) >= 2 and weight >= 2.0) else "allow")
        seen.add(r.verdict)
    assert seen == {"block", "allow"}
    with pytest.raises(ValueError):
        urls.vocabulary(spark.read.parquet(str(tmp_path / "terms")), most=100)


def test_other_tokenizers_are_refused_or_right(spark):
    """A tokenizer that breaks an assumption is an error, never a wrong count."""
    df = spark.createDataFrame([(1, "Hello world. Hello, WORLD"), (2, " a  b\n")], "doc_id long, text string")
    with pytest.raises(ValueError):
        tokens.count_tokens(df, tokenizer_path("byte_bpe_50k.json"))
    from tokenizers import Tokenizer

    word = Tokenizer.from_file(tokenizer_path())
    assert tokens.parts_at_blanks(word) and tokens.folds_case_and_marks(word)
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(df, tokenizer_path()).collect()}
    assert got == {r.doc_id: len(word.encode(r.text, add_special_tokens=False).ids) for r in df.collect()}
