import random
import re

import pytest

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
# Names that operators use inside; they must not get in the way.
CLASHES = (
    "row string, model string, bits double, kept boolean, base string, spans string, key string, n bigint,"
    " shard_no int, label string, chunk int, host string, path string, _text string, component_id bigint"
)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + CLASHES
EMPTY = (None,) * (SCHEMA.count(",") - 4)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, ids=None, langs=None):
        ids = range(len(texts)) if ids is None else ids
        langs = ["en"] * len(texts) if langs is None else langs
        rows = [
            (i, text, lang, "s", None if text is None else len(text), *EMPTY)
            for i, text, lang in zip(ids, texts, langs, strict=True)
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return make


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Copies, edited copies, shared passages, short, empty, missing and long texts."""
    rng = random.Random(11)
    plain = [sentence(rng, rng.randint(20, 150)) for _ in range(30)]
    passage = sentence(rng, 40)
    out = plain + plain[:4] + [plain[5]] * 6
    for text in plain[6:14]:
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        out.append(" ".join(words))
    out += [f"{sentence(rng, 15)}\n{passage}\n{sentence(rng, 9)}" for _ in range(7)]
    out += [None, None, "", "", " \n\t ", "one", "two words", "Three Small words", "three small WORDS"]
    out += ["la " * 400, "É" * 3000, sentence(rng, 6000), "\x00 nul ▁ sign \U0001f600 " * 5, "a\x0bb\x1cc\xa0d" * 9]
    return out
