"""Schemas of the stored tables, as DDL. Tables are never read with inferred types."""

from __future__ import annotations

RLE = "struct<size: array<int>, counts: array<int>>"
VECTOR = "array<double>"

FRAME_TIMESTAMPS = "frame_index bigint, timestamp_s double, duration_s double, file string"
TRACKS = (
    "frame_index bigint, timestamp_s double, object_id bigint, instance_id bigint, label string, bbox_x bigint, bbox_y bigint, "
    "bbox_width bigint, bbox_height bigint, mask_area_px bigint, visibility string, confidence double, source string, "
    "directional_iou double, primary_component_fraction double"
)
HAND_TRAJECTORIES = (
    f"frame_index bigint, timestamp_s double, handedness string, state string, confidence double, wrist_xyz_m {VECTOR}, "
    f"wrist_velocity_mps {VECTOR}, wrist_acceleration_mps2 {VECTOR}, fingertips_xyz_m {VECTOR}"
)
DEPTH_METADATA = (
    "frame_index bigint, timestamp_s double, normalization_low double, normalization_high double, temporal_delta double, "
    "flow_valid_fraction double, stabilization_blend_fraction double, photometric_residual double, sharpness double, "
    "glare_fraction double, invalid_fraction double, confidence double, status string, units string, near_value double, far_value double"
)
FRAME_SCORES = "stage string, frame_index bigint, timestamp_s double, confidence double, status string, reasons string"
QUALITY_FRAMES = "frame_index bigint, confidence double, status string, reasons array<string>"
QUARANTINED = "stage string, start_frame bigint, end_frame bigint, reasons array<string>"
MASKS = f"frame_index bigint, object_id bigint, instance_id bigint, rle {RLE}"
CANDIDATES = (
    f"frame_index bigint, prompt string, detector_score double, sam2_mask_score double, box_xyxy {VECTOR}, mask_rle {RLE}, "
    "clip_scores map<string,double>, clip_logits map<string,double>, clip_best_prompt string, area_fraction double, "
    "aspect_ratio double, embedding array<float>"
)
MANUAL_SEEDS = f"label string, frame_index bigint, box_xyxy {VECTOR}, source string"
CAMERA_PROFILES = (
    "profile string, aliases array<string>, video struct<width: int, height: int, fps: double>, "
    "intrinsics struct<fx: double, fy: double, cx: double, cy: double>"
)

TABLES = {
    "frame_timestamps": FRAME_TIMESTAMPS, "tracks": TRACKS, "hand_trajectories": HAND_TRAJECTORIES, "depth_metadata": DEPTH_METADATA, "frame_scores": FRAME_SCORES,
    "quality_frames": QUALITY_FRAMES, "quarantined": QUARANTINED, "masks": MASKS, "candidates": CANDIDATES, "manual_seeds": MANUAL_SEEDS,
}
