"""The session comes from tests/conftest.py; here is what the tests of this folder share."""
