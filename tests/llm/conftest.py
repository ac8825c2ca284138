import random

import pytest

CLASHING = ("shard", "part", "start", "size", "digest", "key", "text_crc32", "component", "words", "score", "kept")


def edge_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows and clashing extra columns."""
    rng = random.Random(3)
    words = ["the", "Aré", "und,", "naïve", "of", "it's", "x1", "ÉTÉ", "<|endoftext|>", "...", "wòrld!!", "a\x1cb", "日本語", "J̌"]
    long_text = " ".join(rng.choice(words) for _ in range(30_000))
    shared = " ".join(rng.choice(words[:8]) for _ in range(60))
    texts = [None, "", " \n\t", "the", "The the THE", long_text, "abc" * 3_000, shared, shared + " end", "start " + shared,
             "z" * 250, long_text, "x\ny\nx\n\nx", "<|ENDOFTEXT|> <|endoftext|>a", " ", "a\x00b c"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(20, None), (20, "tie"), (20, "tie"), (21, "tie"), (None, "no key"), (None, None), (-5, "below"), (2**40, "far")]
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 300)))) for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    data = [(i, t, None if n % 3 else "en", None if n % 4 else "src", None if n % 5 else len(t or "")) + (n,) * len(CLASHING)
            for n, (i, t) in enumerate(edge_rows())]
    names = ", ".join(f"{c} int" for c in CLASHING)
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {names}").repartition(3)


@pytest.fixture(scope="session")
def edge_folder(edge_docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("edge"))
    edge_docs.write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_folder(edge_docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    edge_docs.limit(0).write.parquet(f"{folder}/documents.parquet")
    return folder
