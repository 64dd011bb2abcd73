"""Declarative report specifications.

A ``ReportSpec`` describes one report file: where it goes (table and column
prefix), which normalised source header feeds each table column, the readable
export label of each column, the key, the ordering rules and the file layout
(preamble lines, footer).  Pipelines (``reportflow.plans.pipelines``) read the
spec instead of carrying rename tables of their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

DERIVED = "*"          # column computed by the pipeline
NOT_EXPORTED = "-"     # column kept in the table but not in the readable export


@dataclass(frozen=True)
class Column:
    name: str            # table column without the table prefix
    source: str          # normalised source header, or DERIVED
    label: str           # readable export label, or NOT_EXPORTED


@dataclass(frozen=True)
class ReportSpec:
    family: str                       # NETWORKS, EXTERNALS, HCMD, PKI, generic
    file_name: str                    # exact delivered file name
    table: str                        # target table (also the column prefix)
    columns: tuple[Column, ...]
    key: str = "unique_id"
    preamble: int = 1
    footer: int = 0
    scope: str = "report_date"        # upsert scope: 'report_date' | 'all' | 'append'
    sort_col: str = "update_date"
    export_order: tuple[str, ...] = ()  # labels; default = table order
    export_labels: bool = True         # False: prefixed table columns are exported
    side_files: tuple[str, ...] = ()

    @property
    def table_columns(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def prefixed(self) -> list[str]:
        return [f"{self.table}_{c.name}" for c in self.columns]

    @property
    def renames(self) -> dict[str, str]:
        """source header -> table column, for columns read from the file."""
        return {c.source: c.name for c in self.columns
                if c.source not in (DERIVED,) and c.source != c.name}

    def export_pairs(self) -> list[tuple[str, str]]:
        """(prefixed table column, export label) in export order."""
        if not self.export_labels:
            return [(p, p) for p in self.prefixed]
        by_label = {c.label: f"{self.table}_{c.name}" for c in self.columns
                    if c.label != NOT_EXPORTED}
        order = list(self.export_order) or [c.label for c in self.columns
                                             if c.label != NOT_EXPORTED]
        return [(by_label[lbl], lbl) for lbl in order if lbl in by_label]


def columns(text: str) -> tuple[Column, ...]:
    """Parse ``name | source | label`` lines."""
    out = []
    for line in text.strip().splitlines():
        name, source, label = (p.strip() for p in line.split("|"))
        out.append(Column(name, source, label))
    return tuple(out)


@dataclass
class Registry:
    specs: dict[str, ReportSpec] = field(default_factory=dict)

    def add(self, spec: ReportSpec) -> ReportSpec:
        self.specs[spec.file_name] = spec
        return spec

    def for_family(self, family: str) -> list[ReportSpec]:
        return [s for s in self.specs.values() if s.family == family]

    def get(self, file_name: str) -> ReportSpec | None:
        return self.specs.get(file_name)
