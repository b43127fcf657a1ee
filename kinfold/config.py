"""Declared columns, limits and thresholds."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values (must equal the published data model, do not edit).
SITE_SET_COLS = (
    "fs_visited_30",
    "fs_visited_365",
    "fs_source_site_365",
    "fs_has_account",
    "fs_has_click_365",
    "fs_has_accept_365",
    "fs_has_order_30",
    "fs_has_order_365",
    "fs_source_site_30",
    "fs_has_click_30",
    "fs_has_accept_30",
    "fs_has_view_90",
)
MATCH_COLS = (
    "first_name",
    "sex",
    "np_device",
    "np_browser",
    "np_osfamily",
    "np_subdivision_1_iso_code",
    "rt_country",
    "rt_is_million",
    "fs_is_man",
    "fs_is_woman",
    "fs_is_gmail",
    "fs_postman_response_90",
)
MATCH_ID_COLS = ("np_geoname_id", "rt_geoid")
DIFF_COLS = ("rt_tz_offset", "rt_local_hour", "rt_day", "rt_population")
AUTO_MERGE_THRESHOLD = 0.998
REVIEW_THRESHOLD = 0.95
MAX_BLOCK_PROFILES = 300
SITE_STOP_DF = 150
MAX_PAIRS_PER_BLOCK = 10_000
NAME_PAIRS_PER_CLASS = 50_000
SWEEP_THRESHOLDS = (0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90)
SECOND_CHOICE_THRESHOLDS = (0.40, 0.50, 0.60, 0.70, 0.80, 0.90)
BASE_COLS = ("first_name", "last_name", "email", "phone", "birthday", "sex")
NP_KEYS = ("device", "browser", "osfamily", "subdivision_1_iso_code", "geoname_id")
RT_KEYS = (
    "country",
    "is_million",
    "tz_offset",
    "geoname",
    "geoid",
    "local_hour",
    "day",
    "population",
    "visit_count",
)
FS_SCALAR_KEYS = ("is_man", "is_woman", "is_gmail", "postman_response_90")
# End of fixed values.


@dataclass(frozen=True)
class ProfileSchema:
    """Which columns the flat table, the profile table and the features have.

    The column list is declared, not inferred: a key that never occurs gives a
    null column instead of a missing one, so the schema does not depend on data.
    """

    base: tuple[str, ...] = BASE_COLS
    np_keys: tuple[str, ...] = NP_KEYS
    rt_keys: tuple[str, ...] = RT_KEYS
    rt_nested: tuple[tuple[str, tuple[str, ...]], ...] = ()
    fs_keys: tuple[str, ...] = FS_SCALAR_KEYS
    site_sets: tuple[str, ...] = SITE_SET_COLS
    match: tuple[str, ...] = MATCH_COLS
    match_ids: tuple[str, ...] = MATCH_ID_COLS
    diffs: tuple[str, ...] = DIFF_COLS

    @property
    def scalars(self) -> tuple[str, ...]:
        """Columns collapsed with the last-non-null rule."""
        return (
            self.base
            + tuple(f"np_{k}" for k in self.np_keys)
            + tuple(f"rt_{k}" for k in self.rt_keys)
            + tuple(f"fs_{k}" for k in self.fs_keys)
        )

    @property
    def feature_names(self) -> list[str]:
        """Feature columns in output order."""
        names = [f"match_{c}" for c in self.match + self.match_ids + ("email_domain",)]
        names += [f"diff_{c}" for c in self.diffs] + ["diff_created_days"]
        for c in self.site_sets:
            names += [f"jaccard_{c}", f"overlap_{c}"]
        return names + ["overlap_any_site"]


DEFAULT_SCHEMA = ProfileSchema()
