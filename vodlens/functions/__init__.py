"""Column-level functions (JVM-side expressions, no UDFs)."""

from .exprs import (
    APP_BY_ID,
    FOLDER_BY_APP,
    MAIN_APPS,
    app_from_id,
    capped,
    is_number,
    key,
    level,
    log_is,
    main_menu_folder,
    num,
    playing_time,
    position,
    submenu,
)
from .fmt import day_label, fmt_unit, hour_label

__all__ = [
    "APP_BY_ID",
    "FOLDER_BY_APP",
    "MAIN_APPS",
    "app_from_id",
    "capped",
    "day_label",
    "fmt_unit",
    "hour_label",
    "is_number",
    "key",
    "level",
    "log_is",
    "main_menu_folder",
    "num",
    "playing_time",
    "position",
    "submenu",
]
