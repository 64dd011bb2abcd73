"""Shared fixtures: one local Spark session for the whole test run, small helpers."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reportflow.session import local_session
    s = local_session(4, shuffle_partitions=4, app="reportflow-tests")
    yield s


def rows(df, order=None):
    """Collected rows as tuples, sorted for order-insensitive comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple("" if v is None else str(v) for v in t))


def write_report(path, lines, encoding="utf-8"):
    """Write a report file from a list of text lines."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write("\n".join(lines) + "\n")
    return path
