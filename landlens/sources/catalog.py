"""Named results as temporary views, with a dependency graph.

A name is a base table, a builder, or a SQL text over other names.  The registry knows
which names each result reads: declared with the definition, taken from the
placeholders of a SQL text, and recorded while a builder runs.  Whatever changes a name
(``define`` again, ``set_table``, ``replace``, ``drop``) walks the graph: results built on
the old state are forgotten, and those that are registered as views are built and
registered again, inputs first.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[["ViewRegistry"], DataFrame]


class DependencyError(ValueError):
    """A name is still read by others, or reads itself."""


class ViewRegistry:
    """Register builder functions under names; ``get`` resolves dependencies.

    Each builder receives the registry and asks for its inputs by name.  A result
    that others use may be replaced by its written table (``replace``), so it is
    computed once.  ``register`` exposes everything to ``spark.sql``.
    """

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame]):
        self.spark = spark
        self._tables = dict(tables)
        self._builders: dict[str, Builder] = {}
        self._reads: dict[str, set[str]] = {}
        self._built: dict[str, DataFrame] = {}
        self._pinned: set[str] = set()
        self._registered: set[str] = set()
        self._running: list[str] = []

    # -- definitions ----------------------------------------------------------
    def define(self, name: str, builder: Builder, reads: Iterable[str] = ()) -> list[str]:
        """Defines or redefines ``name``; ``reads`` are names that the builder will ask for.

        On a redefinition every result that reads ``name``, directly or not, is built
        anew from now on, written replacements included; of those that are
        registered, the views are replaced at once.  If one of them can't be built on
        the new definition, the old state is kept and the error raised.  Returns the
        names of the dependants, inputs first.
        """
        if name in self._tables:
            raise DependencyError(f"{name!r} is a base table; use set_table")
        before = self._state()
        self._builders[name], self._reads[name] = builder, set(reads)
        return self._changed(name, before)

    def define_sql(self, name: str, text: str) -> list[str]:
        """``define`` by a SQL text in which ``{other}`` stands for the result ``other``."""
        reads = {field for _, field, _, _ in string.Formatter().parse(text) if field}
        return self.define(name, lambda g: g.spark.sql(text, **{r: g.get(r) for r in sorted(reads)}), reads)

    def set_table(self, name: str, table: DataFrame) -> list[str]:
        """A new state of a base table, for all that read it."""
        if name in self._builders:
            raise DependencyError(f"{name!r} is a view; use define")
        before = self._state()
        self._tables[name] = table
        return self._changed(name, before)

    def replace(self, name: str, table: DataFrame) -> None:
        """Use ``table`` (the written result of ``name``) wherever ``name`` is asked for, until something that ``name`` reads changes.

        Dependants that were built on the unwritten result are built anew on the
        table; those that are replaced themselves hold the same rows and stay.
        """
        if name not in self._builders:
            raise KeyError(f"no view named {name!r}")
        self._built[name] = table
        self._pinned.add(name)
        for d in self.dependants(name):
            if d not in self._pinned:
                self._built.pop(d, None)
        self._refresh([name, *self.dependants(name)])

    def drop(self, name: str, cascade: bool = False, if_exists: bool = False) -> list[str]:
        """Drops a view and its temporary view; with ``cascade`` all that read it, directly or not, else refuses if there are any.

        Returns what was dropped, readers before what they read.
        """
        if name not in self._builders:
            if if_exists and name not in self._tables:
                return []
            raise KeyError(f"no view named {name!r}")
        gone = [name, *self.dependants(name)][::-1]
        if len(gone) > 1 and not cascade:
            raise DependencyError(f"{name!r} is read by {', '.join(gone[:-1])}")
        for n in gone:
            del self._builders[n]
            self._reads.pop(n, None)
            self._built.pop(n, None)
            self._pinned.discard(n)
            if n in self._registered:
                self.spark.catalog.dropTempView(n)
                self._registered.discard(n)
        return gone

    # -- graph ----------------------------------------------------------------
    def reads(self, name: str) -> set[str]:
        """What ``name`` reads directly, as far as it is declared or was seen."""
        return set(self._reads.get(name, ()))

    def dependants(self, name: str) -> list[str]:
        """All views that read ``name``, directly or not, inputs before their readers."""
        hit = {name}
        while more := {n for n, r in self._reads.items() if n not in hit and r & hit}:
            hit |= more
        return [n for n in self.order() if n in hit and n != name]

    def order(self) -> list[str]:
        """All views, inputs before their readers, else in the order of their definition."""
        out: dict[str, None] = {}

        def visit(name: str, path: tuple[str, ...]) -> None:
            if name in path:
                raise DependencyError("views read each other: " + " -> ".join((*path[path.index(name):], name)))
            if name in self._builders and name not in out:
                for r in [b for b in self._builders if b in self._reads.get(name, ())]:
                    visit(r, (*path, name))
                out[name] = None

        for name in self._builders:
            visit(name, ())
        return list(out)

    # -- results --------------------------------------------------------------
    def get(self, name: str) -> DataFrame:
        if self._running:
            self._reads.setdefault(self._running[-1], set()).add(name)
        if name in self._tables:
            return self._tables[name]
        if name in self._running:
            raise DependencyError("views read each other: " + " -> ".join((*self._running[self._running.index(name):], name)))
        if name not in self._built:
            if name not in self._builders:
                raise KeyError(f"no table or view named {name!r}")
            self._running.append(name)
            try:
                self._built[name] = self._builders[name](self)
            finally:
                self._running.pop()
        return self._built[name]

    def names(self) -> list[str]:
        return [*self._tables, *self._builders]

    def register(self, *names: str) -> list[str]:
        """Temporary views for the named tables and views (all by default), inputs first; they follow later changes."""
        listed = [n for n in [*self._tables, *self.order()] if not names or n in names]
        if unknown := set(names) - set(listed):
            raise KeyError(f"no table or view named {sorted(unknown)}")
        frames = {n: self.get(n) for n in listed}
        for n, frame in frames.items():
            frame.createOrReplaceTempView(n)
        self._registered |= set(listed)
        return listed

    # -- state ----------------------------------------------------------------
    def _state(self) -> tuple:
        return (dict(self._tables), dict(self._builders), {n: set(r) for n, r in self._reads.items()}, dict(self._built), set(self._pinned))

    def _changed(self, name: str, before: tuple) -> list[str]:
        """Forgets what was built on the old ``name`` and replaces the registered views; restores ``before`` if that fails."""
        try:
            hit = self.dependants(name)
            for n in (name, *hit):
                self._built.pop(n, None)
                self._pinned.discard(n)
            self._refresh([name, *hit])
        except Exception:
            self._tables, self._builders, self._reads, self._built, self._pinned = before
            raise
        return self.dependants(name)

    def _refresh(self, names: Iterable[str]) -> None:
        """Builds all registered ones of ``names`` before the first view is replaced."""
        frames = {n: self.get(n) for n in names if n in self._registered}
        for n, frame in frames.items():
            frame.createOrReplaceTempView(n)
