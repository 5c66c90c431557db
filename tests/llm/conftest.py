import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators add or use inside.
CLASHING = ", size long, shard int, slot long, fp long, component_id long, score double, copies int, found string, row_number long, carried_row long"


@pytest.fixture
def documents(spark):
    """Documents from (id, text, source)."""

    def made(data, clashing=False):
        rows = [(i, t, "en", s, None if t is None else len(t)) + ((7,) * 4 + (7, 0.5, 7, "x", 7, 7) if clashing else ()) for i, t, s in data]
        return spark.createDataFrame(rows, DOCUMENT + CLASHING * clashing)

    return made
