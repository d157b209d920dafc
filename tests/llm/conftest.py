import random

import pytest

from moonstride.llm.shipping import ship_library

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, score double, t long, kept string, items string, spans int, h1 long, placed int"
)


def tricky_rows():
    """Documents with nulls, empty and long texts, copies, near copies, shared lines, odd characters."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "Δelta", "été", "x", "word-y", "naïve", "ÉCOLE", "the", "of", "日本語", "z9"]
    text = lambda n, sep=" ": sep.join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    long = text(4000)
    shared = "This very line stands in many documents, WORD for word."
    passage = text(40)
    near = text(120).split(" ")
    texts = [
        None, "", " \t\n ", "one", "one", "a b c d", "a  b\tc\x0bd", long, text(300), text(80),
        f"{text(9)}\n{shared}\n{text(7)}", f"{shared.lower()}  \n\n{text(3)}", f"  {shared}\n{shared}\n", f"x\n{shared}\r\ny",
        " ".join(near), " ".join(near[:60] + ["edit"] + near[60:]), " ".join(near[:-3]), " ".join(near).upper(), " ".join(near),
        f"{text(20)} {passage} {text(5)}", f"{passage} {passage}", f"q\n{passage}", "12 !!! 34 ###", "\x00 nul\x1cfs\x85nel\xa0nbsp",
        "<|endoftext|> said <|endoftext|>", "   lead  and   trail   \n\n", "é \U0001f600\U0001f600 ​", "tie tie tie tie tie tie tie tie tie tie tie",
    ]
    ids = [7, 3, 3, 40, 41, *range(50, 50 + len(texts) - 5)]
    rows = list(zip(ids, texts)) + [(None, "without an id " + passage), (None, None), (54, texts[9])]
    langs = ["en", "fr", None]
    return [
        (i, t, langs[k % 3], "s", None if t is None else len(t), "r", 0.5, 1, "k", "i", 2, 3, 4) for k, (i, t) in enumerate(rows)
    ]


@pytest.fixture(scope="session")
def llm(spark):
    ship_library(spark)
    return spark


@pytest.fixture(scope="session")
def tricky(llm):
    return llm.createDataFrame(tricky_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(llm):
    return llm.createDataFrame([], SCHEMA)
