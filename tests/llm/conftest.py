import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def corpus(spark):
    """The session, with the package known to its Python workers."""
    from civicmart.llm.common import ship_package
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def frame(corpus):
    """documents-like frames from (doc_id, text) pairs, with extra and clashing columns."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, "
              "th long, h long, owner string, `_keep` string, norm string, `_h` string, `_flagged` string")

    def make(rows, lang="en"):
        data = [(d, t, lang if not isinstance(lang, dict) else lang.get(d), "s", None, 1, 2, "x",
                 "y", "z", "h", "f") for d, t in rows]
        return corpus.createDataFrame(data, schema).repartition(3)

    return make
