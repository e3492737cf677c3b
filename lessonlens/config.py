"""Fixed business constants, gathered in one place.

A deployment overrides them through ``Constants(...)``; the defaults are the
values used by the supplied fixture tables.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------
# Lesson types that never count as allocated work (compared after lower(trim())).
EXCLUDED_LESSON_TYPES = ("pdf", "mp4", "pdf web")
# User types: 1 admin, 2 facilitator / master trainer, 3 learner, 4 alumni.
USER_TYPES = (1, 2, 3, 4)
LEARNER_TYPES = (3, 4)
STAFF_TYPES = (1, 2)
# Batch status that marks an archived batch.
ARCHIVED_BATCH_STATUS = 4
# Assessment stages and their display order.
STAGES = ("baseline", "endline")
# Output labels.
USER_TYPE_LABELS = {1: "Admin", 2: "Facilitator", 3: "Learner", 4: "Alumni"}
MASTER_TRAINER_LABEL = "Master Trainer"
MISSING_LABEL = "Missing Data"
PLE_LABELS = ("PLE", "Non-PLE")
PLE_CENTRE_LABELS = ("PLE Centre", "Non-PLE Centre")
BATCH_LABELS = ("In Batch", "Not in Batch")
GENDER_LABELS = ("Male", "Female", "Other")
# Allocation path names.
PATH_NON_PLE, PATH_PLE, PATH_STAFF = "non_ple", "ple", "staff"
# Separator of ordered distinct string lists.
LIST_SEPARATOR = " | "
# Id pattern accepted by the key validator (canonical UUID text).
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
# Epoch used when no high-water mark exists.
EPOCH = "1970-01-01 00:00:00"
# Overlap subtracted from the high-water mark.
DEFAULT_OVERLAP_MINUTES = 5
# Warning threshold for a per-centre row drop between snapshots.
CENTRE_DROP_THRESHOLD = 0.20
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Constants:
    """Deployment-specific ids.  Defaults match the fixture tables."""

    lesson_category_id: int = 0
    english_language_id: int = 0
    baseline_assessment_ids: tuple = (0, 1, 2)
    endline_assessment_ids: tuple = (3, 4, 5)
    programme_scope: tuple = ("Program A", "Program B")
    default_centre_types: tuple = ("iti",)
    excluded_lesson_types: tuple = EXCLUDED_LESSON_TYPES
    # Largest dimension (rows) that may be broadcast; above it a shuffle join is used.
    broadcast_row_limit: int = 2_000_000

    @property
    def assessment_ids(self) -> tuple:
        return tuple(self.baseline_assessment_ids) + tuple(self.endline_assessment_ids)


DEFAULT = Constants()
