"""The queries over the given tables; importing the package registers all of them."""

from . import claims, desk, imports, ledgers, live, people, queries, reading, resolving, store, texts  # noqa: F401
