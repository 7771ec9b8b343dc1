"""Tabular machine-learning operations as Spark DataFrame operators."""

from tabwright.roles import Roles

__all__ = ["Roles"]
