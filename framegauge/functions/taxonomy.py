"""Fixed values that results depend on: problem families, score dimensions, points, enums and detector defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Family -> (category id, category name, score dimension).
FAMILIES = {
    "vision_illegal": ("1.1.1.A", "Vision data illegal problem", "structural"),
    "state_illegal": ("1.1.1.B", "State data illegal problem", "structural"),
    "vision_single": ("1.1.2.A", "Vision single-frame quality problem", "vision_single"),
    "vision_vision": ("1.1.2.B", "Vision-Vision consistency problem", "vision_vision"),
    "vision_state_vision": ("1.1.2.C", "Vision-State-Vision geometry/scale problem", "cross_modal"),
    "state_vision_state": ("1.1.2.D", "State-Vision-State consistency problem", "cross_modal"),
    "temporal_illegal": ("1.2.1", "Temporal illegal problem", "structural"),
    "vision_temporal": ("1.2.2.A", "Vision frozen/fast/jitter problem", "temporal"),
    "state_temporal": ("1.2.2.B", "State frozen/fast/jitter problem", "temporal"),
    "vision_state_temporal": ("1.2.2.C", "Vision-State temporal consistency problem", "cross_modal"),
}
# Points of each score dimension, caps of soft penalties, official weights.
DIMENSION_POINTS = {"structural": 25.0, "vision_single": 20.0, "vision_vision": 10.0, "state": 15.0, "temporal": 15.0, "cross_modal": 15.0}
SOFT_CAPS = {"vision_single": 0.8, "vision_vision": 0.6, "temporal": 2.0, "cross_modal": 1.2}
OFFICIAL_POINTS = {"detection_quality": 70.0, "data_value": 20.0, "engineering_reliability": 10.0}
# Confidence labels and module statuses.
CONFIDENCE = {"illegal": "确定异常", "ood": "分布外样本", "high": "高置信异常", "suspect": "疑似异常"}
STATUSES = ["ok", "warning", "unavailable", "fail"]
# First-generation severity labels.
LABEL_PENALTY = {"critical": 25.0, "high": 12.0, "medium": 5.0, "low": 2.0, "info": 0.0}
# Layout of the 20-dimensional state vector, from 1: (first, length).
ARMS = {"left": {"pos": (1, 3), "rot": (4, 6), "grip": (10, 1)}, "right": {"pos": (11, 3), "rot": (14, 6), "grip": (20, 1)}}
VIEWS = ["image", "left_wrist_image", "right_wrist_image"]
LOW_DIM = ["state", "actions"]
INDEX_COLUMNS = ["timestamp", "frame_index", "episode_index", "index", "task_index"]
# Families that count as a hit for an expected family.
FAMILY_ALIASES = {
    "vision_single": ["vision_single", "vision_illegal"],
    "vision_illegal": ["vision_illegal", "vision_single"],
    "state_temporal": ["state_temporal", "vision_state_temporal"],
    "vision_state_temporal": ["vision_state_temporal", "state_temporal", "vision_temporal"],
}
# Families of broken rules, which count as located without a span.
HARD_FAMILIES = ["vision_illegal", "state_illegal", "temporal_illegal"]


def families(spark: SparkSession) -> DataFrame:
    """The taxonomy as a dimension table of ten rows: family, category_id, category_name, dimension, points."""
    rows = [(k, i, n, d, DIMENSION_POINTS[d]) for k, (i, n, d) in FAMILIES.items()]
    return spark.createDataFrame(rows, "family string, category_id string, category_name string, dimension string, points double")
