import pytest
from pyspark.sql import Row

# Null columns, empty and blank texts, a very long word and text, ties, repeated rows, clashing names.
LONG = "lorem ipsum dolor sit amet consectetur " * 4000


@pytest.fixture(scope="session")
def odd(spark):
    """Documents of every awkward kind, with extra columns named like those the operators add."""
    texts = [
        None,
        "",
        " \n\t ",
        "x" * 200_000,
        LONG,
        "One, two; three four five six. Seven eight\nnine ten",
        "One, two; three four five six. Seven eight\nnine ten",
        "mail a.b@c.de and +1 (555) 123-4567 from 10.0.0.1 with 4111 1111 1111 1111",
        "Released under the MIT License.\nRELEASED UNDER THE MIT LICENSE",
        "ünï çødé 漢字 \U0001f600 ' s's    end",
    ]
    extras = dict(size=1, copies=2, fingerprint="f", component_id=5, spans="s", kept="k", shard=3, slot=4, ids="i", g=1, score="z", target=9, distance="d")
    rows = [Row(doc_id=i, text=t, lang=["en", "de", None][i % 3], source=["b", None, "a"][i % 3], n_chars=0, **extras) for i, t in enumerate(texts)]
    rows += [Row(doc_id=None, text="no id here", lang="en", source="a", n_chars=None, **extras)] * 2
    rows += [rows[5], rows[5]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, copies int, fingerprint string, component_id int, spans string, kept string, shard int, slot int, ids string, g int, score string, target int, distance string"
    return spark.createDataFrame(rows, schema).repartition(3).checkpoint()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
