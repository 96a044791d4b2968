"""Public API: everything exported is importable and documented."""

from __future__ import annotations

import importlib

import pytest

MODULES = ["gridlake.operators", "gridlake.functions", "gridlake.sources", "gridlake.streaming"]


@pytest.mark.parametrize("mod", MODULES)
def test_exports_have_docstrings(mod):
    m = importlib.import_module(mod)
    missing = [n for n in m.__all__ if not (getattr(m, n).__doc__ or "").strip()]
    assert not missing, f"{mod}: undocumented {missing}"
