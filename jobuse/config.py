"""Parameters of an analysis run."""

from __future__ import annotations

from dataclasses import dataclass

UNITS = ("Nodeh", "Coreh")


@dataclass(frozen=True)
class UsageConfig:
    """What the command line of a usage report would set.

    ``family='usage'`` works on job steps, ``family='energy'`` on whole jobs.
    """

    family: str = "usage"
    cpn: int = 128                  # cores per node
    gpn: int = 4                    # GPUs per node
    max_power: float = 850.0        # W per node, larger readings are counter errors
    max_energy_j: float = 1e16      # J, larger readings are counter errors
    unknown_thresh: float = 0.01    # share of use that makes an unidentified exe significant
    units: str = "Nodeh"
    gpu: bool = False
    shared_node: bool = False
    drop_nan: bool = False
    coreh_subnode: str = "fixed"    # 'reference': sub-node rows stay in node-hours under Coreh
    exclude_states: str = "RUNNING|PENDING|REQUEUED"
    account: str | None = None      # restrict the report to one project id
    user_split: bool = False
    anonymise: bool = True
    report_energy: bool | None = None
    web: bool = False               # energy report: hide absolute use and energy
    approx: bool = False            # quartiles of node power from one pass, to within one slice of its range

    def __post_init__(self):
        if self.family not in ("usage", "energy"):
            raise ValueError(f"family must be 'usage' or 'energy', not {self.family!r}")
        if self.units not in UNITS:
            raise ValueError(f"units must be one of {UNITS}, not {self.units!r}")
        if self.coreh_subnode not in ("fixed", "reference"):
            raise ValueError("coreh_subnode must be 'fixed' or 'reference'")
        if self.family == "energy" and (self.gpu or self.units != "Nodeh"):
            raise ValueError("the energy family reports node-hours only")

    @property
    def unit_name(self) -> str:
        return "GPUh" if self.gpu else self.units

    @property
    def size_measure(self) -> str:
        if self.family == "energy":
            return "nodes"
        return "ngpus" if self.gpu else "cores"

    @property
    def use_divisor(self) -> float:
        """Unit-seconds in one reported hour.

        Use is kept per row as a whole number of unit-seconds, so sums do not
        depend on the order of partial aggregates; it is divided once, at the end.
        """
        if self.family == "energy" or self.shared_node:
            return 3600.0
        if self.gpu:
            return 3600.0 * self.gpn
        if self.units == "Coreh" and self.coreh_subnode == "fixed":
            return 3600.0
        return 3600.0 * self.cpn

    @property
    def shows_energy(self) -> bool:
        if self.report_energy is None:
            return self.family == "energy"
        return self.report_energy
