"""Registered queries by topic."""

from importlib import import_module

TOPICS = ("tables", "features", "splits", "models", "experiments", "monitoring", "tracking", "explanations", "streams")


def load_all() -> None:
    for topic in TOPICS:
        import_module(f"tabwright.plans.{topic}")
