"""Components of edges between numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd

from quillstone.operators import graph
from quillstone.operators.graph import components

__all__ = ["Forest", "components"]


class Forest(graph.Forest):
    def edges(self) -> pd.DataFrame:
        return pd.DataFrame(self.pairs(), columns=["a", "b"]).astype(np.int64)
