import os
import sys

import numpy as np
import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from tideframe.session import build_session

    return build_session("tideframe-tests", 8, 4)


@pytest.fixture(scope="session")
def walk():
    """Seeded hourly series with a daily swing; several series come interleaved and out of order."""

    def make(rows=200, coins=("a", "b"), seed=11, gaps=False):
        rng, frames = np.random.default_rng(seed), []
        for coin in coins:
            hours = pd.date_range("2022-01-01", periods=rows, freq="h")
            swing = np.sin(np.arange(rows) * 2 * np.pi / 24)
            frames.append(
                pd.DataFrame(
                    {
                        "coin_id": coin,
                        "timestamp": hours,
                        "price": 640 + 25 * swing + np.cumsum(rng.normal(size=rows) * 1.5),
                        "market_cap": 5e7 + 4e4 * swing + np.cumsum(rng.normal(size=rows) * 2e4),
                        "total_volume": 3e5 * np.exp(rng.normal(size=rows) * 0.1),
                    }
                )
            )
        out = pd.concat(frames, ignore_index=True)
        if gaps:
            out = out[rng.uniform(size=len(out)) > 0.15]
        out["ingest_seq"] = range(len(out))
        return out.sample(frac=1, random_state=seed).reset_index(drop=True)

    return make
