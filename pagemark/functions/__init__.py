"""Column expressions: native Spark SQL only, so they also work on streaming DataFrames."""

from pagemark.functions.boxes import (  # noqa: F401
    box_coordinate,
    box_coordinates,
    confidence_band,
    inside_region,
    ranking_probability,
    within_coordinate_range,
)
from pagemark.functions.labels import bio_type, decode, strip_bio  # noqa: F401
from pagemark.functions.text import (  # noqa: F401
    file_stem,
    from_template,
    is_blank,
    percent,
    ratio,
    real_number,
    shorten,
    whole_number,
)
