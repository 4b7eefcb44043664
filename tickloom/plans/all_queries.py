"""Imports every module that registers queries."""

from __future__ import annotations

import importlib

MODULES = ("q_bars", "q_scalars", "q_orders", "q_relational", "q_streaming", "q_io")


def load() -> None:
    """Register all queries once."""
    for name in MODULES:
        importlib.import_module(f"tickloom.plans.{name}")
