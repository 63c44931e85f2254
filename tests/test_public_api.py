"""The package exports its operators, plans, sources and functions."""

from __future__ import annotations

import importlib


def test_public_names_resolve():
    for mod in ("churnlens.operators", "churnlens.plans", "churnlens.sources", "churnlens.functions",
                "churnlens.streaming"):
        m = importlib.import_module(mod)
        for name in m.__all__:
            assert getattr(m, name) is not None, (mod, name)
