"""Every test file can be collected whatever other test folders are on the path."""

import pathlib

TESTS = pathlib.Path(__file__).parent


def test_nothing_is_imported_from_a_conftest():
    files = [p for p in TESTS.rglob("*.py") if p != pathlib.Path(__file__)]
    assert not [p.name for p in files if "from conftest" in p.read_text() or "import conftest" in p.read_text()]


def test_helper_modules_have_names_of_their_own():
    names = [p.stem for p in TESTS.rglob("*.py") if p.stem not in ("conftest", "__init__")]
    assert len(names) == len(set(names))
