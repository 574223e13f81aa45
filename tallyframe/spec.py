"""Description of one survey table: which columns matter and how the outcome is coded."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class SurveySpec:
    """Column allow-list and outcome coding shared by all plans.

    ``columns`` lists features and target in output order; names missing from
    the data are skipped, except the target.  ``recode`` maps raw outcome codes
    to analysis codes, ``unknown`` lists raw codes that mean "no answer".
    ``continuous`` names measured features, which are ranked by so many
    equal-width bins, ``measured`` such that are ranked by nearest neighbours;
    all other features are ranked by their values.
    """

    target: str
    columns: Sequence[str] | None = None
    recode: Mapping[float, float] = field(default_factory=lambda: {2: 0})
    unknown: Sequence[float] = (7, 9)
    max_missing_pct: float = 40.0
    continuous: Mapping[str, int] = field(default_factory=dict)
    measured: Sequence[str] = ()

    def __post_init__(self):
        unknown = set(self.unknown)
        if unknown & set(self.recode) or unknown & set(self.recode.values()):
            raise ValueError("a code cannot be both recoded and unknown")
        if self.columns is not None and self.target not in self.columns:
            raise ValueError(f"target {self.target!r} is not in the column list")

    def present(self, available: Sequence[str]) -> list[str]:
        """Allow-listed names that exist in ``available``, in allow-list order."""
        if self.columns is None:
            return list(available)
        have = set(available)
        return [name for name in self.columns if name in have]


# Public codebook names of the heart-attack survey extract, in
# output order.  They have to be spelled as in the published survey files.
HEART_SURVEY = SurveySpec(
    target="CVDINFR4",
    columns=(
        "_MICHD", "CHOLMED3", "GENHLTH", "MAXVO21_", "EMPLOY1", "BPHIGH6",
        "DIABETE4", "CVDSTRK3", "_AGE80", "VETERAN3", "CHCCOPD3", "CHILDREN",
        "_DRDXAR2", "DEAF", "DIFFWALK", "TOLDHI3", "PHYSHLTH", "CHCKDNY2",
        "FALL12MN", "_RFCHOL3", "TRNSGNDR", "PVTRESD3", "PRIMINS1", "HAVARTH4",
        "DIFFALON", "SMOKE100", "ASTHMA3", "LANDLINE", "CHCOCNC1", "CVDINFR4",
    ),
)
