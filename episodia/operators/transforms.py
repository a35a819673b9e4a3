"""Named transforms and per-dataset standardizers (survey rows F1-F6, P14-P16, W14-W16 by configuration)."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType

from ..functions import geometry
from . import windows

Transform = Callable[[DataFrame], DataFrame]
REGISTRY: dict[str, Transform] = {}


def register(name: str) -> Callable[[Transform], Transform]:
    """keeps a transform under a name."""

    def keep(f: Transform) -> Transform:
        if name in REGISTRY:
            raise ValueError(f"{name} is taken")
        REGISTRY[name] = f
        return f

    return keep


def named(name: str) -> Transform:
    """the transform of a name; an unknown one is an error that lists the known."""
    if name not in REGISTRY:
        raise KeyError(f"no transform {name}; there are {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name]


def compose(transforms: Iterable[Transform]) -> Transform:
    """one after the other."""
    return lambda df: reduce(lambda d, f: d.transform(f), transforms, df)


@dataclass(frozen=True)
class Group:
    """transforms of what goes in and of what comes out; push() adds inputs at the end and outputs at the front."""

    inputs: tuple[Transform, ...] = ()
    outputs: tuple[Transform, ...] = ()

    def push(self, inputs: Iterable[Transform] = (), outputs: Iterable[Transform] = ()) -> Group:
        return Group((*self.inputs, *inputs), (*outputs, *self.outputs))


#: A piece of a vector: `column`, `column[a:b]` as in Python, `0*column[a:b]` for as many zeros (1* for ones), and changes
#: after bars, as in `action[-1:]|clip|invert`.
PIECE = re.compile(r"(?:(?P<fill>[01])\*)?(?P<column>\w+)(?:\[(?P<begin>-?\d*):(?P<end>-?\d*)\])?(?P<changes>(?:\|\w+)*)")
#: What may be done to every element.
CHANGES: dict[str, Callable[[Column], Column]] = {
    "invert": lambda x: 1 - x,
    "clip": lambda x: F.greatest(F.least(x, F.lit(1.0)), F.lit(0.0)),
}
#: What may be done to a single element by the others of its episode: (frames, value) -> frames with the result in `gripper`.
RELABELS: dict[str, Callable[[DataFrame, str], DataFrame]] = {"binarize": windows.binarize_gripper, "absolute": windows.relative_gripper_to_absolute}


@dataclass(frozen=True)
class Standard:
    """P16 as a table: columns put together from pieces, parted by blanks, or texts taken from a column.

    drop_first leaves out an episode's first frame; reached replaces the action's first six numbers by the way to the next
    frame's state and leaves out the last frame (W14). depth: images by the column they come from, which frames without
    images may lack; `column[0]` is the first channel of each pixel. Values that lie in both the action and the
    observation are told apart by action_ before the action's.
    """

    vectors: dict[str, str] = field(default_factory=dict)
    instruction: str | None = None
    drop_first: bool = False
    reached: bool = False
    depth: dict[str, str] = field(default_factory=dict)


NATURAL = "natural_language_instruction"
MOVES = "world_vector rotation_delta"
LAST_STATE = {"eef_state": "state[:6]", "gripper_state": "state[-1:]"}
INVERTED = {"action": "action[:6] action[-1:]|clip|invert"}
#: By dataset what its frames are made of. Fixed values.
STANDARDS: dict[str, Standard] = {
    "bridge_oxe": Standard({"action": f"{MOVES} open_gripper", **LAST_STATE}, NATURAL, drop_first=True, reached=True),
    "bridge_orig": Standard({"action": "action[:6] action[-1:]|binarize", **LAST_STATE}, drop_first=True, reached=True),
    "ppgm": Standard({"action": "action[:6] action[-1:]|binarize", "eef_state": "cartesian_position[:6]", "gripper_state": "gripper_position[-1:]"}),
    "rt1": Standard({"action": f"{MOVES} gripper_closedness_action[:1]|absolute"}, NATURAL),
    "kuka": Standard({"action": f"{MOVES} gripper_closedness_action[:1]|absolute", "base_pose_tool_reached": "base_pose_tool_reached|inflate", "gripper_closed": "gripper_closed|inflate"}, NATURAL),
    "taco_play": Standard({"action": "rel_actions_world[:6] rel_actions_world[-1:]|clip", "state_eef": "robot_obs[:6]", "state_gripper": "robot_obs[7:8]"}, NATURAL),
    "jaco_play": Standard({"action": "world_vector 0*world_vector gripper_closedness_action[:1]|absolute", "state_eef": "end_effector_cartesian_pos[:6]", "state_gripper": "end_effector_cartesian_pos[-1:]"}, NATURAL),
    "berkeley_cable_routing": Standard({"action": f"{MOVES} 0*world_vector[:1]"}, NATURAL),
    "roboturk": Standard({"action": f"{MOVES} gripper_closedness_action|clip|invert"}, NATURAL),
    "nyu_door_opening": Standard({"action": f"{MOVES} gripper_closedness_action[:1]|absolute"}, NATURAL),
    "viola": Standard({"action": f"{MOVES} gripper_closedness_action|clip|invert"}, NATURAL),
    "berkeley_autolab_ur5": Standard({"action": f"{MOVES} gripper_closedness_action[:1]|absolute", "state": "robot_state[6:14]"}, NATURAL, depth={"depth": "image_with_depth"}),
    "toto": Standard({"action": f"{MOVES} open_gripper"}, NATURAL),
    "language_table": Standard({"action": "action 0*action 0*action 1*action[:1]"}, "instruction"),
    "pusht": Standard({"action": f"{MOVES} gripper_closedness_action"}, NATURAL),
    "stanford_kuka_multimodal": Standard({"action": "action[:3] 0*action[:3] action[-1:]"}, depth={"depth_image": "depth_image[0]"}),
    "nyu_rot": Standard({"action": "action[:7]", **LAST_STATE}),
    "stanford_hydra": Standard({"action": "action[:6] action[-1:]|invert", "eef_state": "state[:3] state[7:10]", "gripper_state": "state[-3:-2]"}),
    "austin_buds": Standard({**INVERTED, "state": "state[:8]"}),
    "nyu_franka_play": Standard({"action": "action[-8:-2] action[-2:-1]|clip", "eef_state": "state[-6:]"}, depth={"depth": "depth[0]", "depth_additional_view": "depth_additional_view[0]"}),
    "maniskill": Standard({"gripper_state": "state[7:8]"}),
    "furniture_bench": Standard({"action": "action[:3] action[3:7]|euler action[-1:]|clip|invert", "state": "state[:7] state[-1:]"}),
    "cmu_franka_exploration": Standard({"action": "action[:-1]"}),
    "ucsd_kitchen": Standard({"action": "action[:-1]", "joint_state": "state[:7]"}),
    "ucsd_pick_place": Standard({"action": "action[:3] 0*action[:3] action[-1:]", **LAST_STATE}),
    "austin_sailor": Standard(INVERTED),
    "austin_sirius": Standard(INVERTED),
    "bc_z": Standard({"action": "xyz_residual[:3] axis_angle_residual[:3] target_close[:1]|invert"}, NATURAL),
    "tokyo_pr2_opening_fridge": Standard({"action": "action[:-1]", **LAST_STATE}),
    "tokyo_pr2_tabletop_manipulation": Standard({"action": "action[:-1]", **LAST_STATE}),
    "utokyo_xarm_pick_place": Standard(),
    "utokyo_xarm_bimanual": Standard({"action": "action[-7:]"}),
    "robo_net": Standard({"action": "action[:4] 0*action[:2] action[-1:]", "eef_state": "state[:4] 0*state[:2]", "gripper_state": "state[-1:]"}),
    "berkeley_mvp": Standard(),
    "berkeley_rpt": Standard(),
    "kaist_nonprehensible": Standard({"action": "action[:6] 0*action[:1]", "state": "state[-7:]"}),
    "stanford_mask_vit": Standard({"action": "action[:4] 0*action[:2] action[-1:]", "eef_state": "end_effector_pose[:4] 0*end_effector_pose[:2]", "gripper_state": "end_effector_pose[-1:]"}),
    "tokyo_lsmo": Standard(LAST_STATE),
    "dlr_sara_pour": Standard(),
    "dlr_sara_grid_clamp": Standard({"state": "state[:6]"}),
    "dlr_edan_shared_control": Standard({"action": "action[:6] action[-1:]|invert"}),
    "asu_table_top": Standard({"eef_state": "ground_truth_ee", "gripper_state": "state[-1:]"}),
    "robocook": Standard(LAST_STATE),
    "imperial_wristcam": Standard({"action": "action[:-1]"}),
    "iamlab_pick_insert": Standard({"action": "action[:3] action[3:7]|euler action[7:8]", "joint_state": "state[:7]", "gripper_state": "state[7:8]"}),
    "uiuc_d3field": Standard({"action": "action 0*action 0*action[:1]"}),
    "utaustin_mutex": Standard({**INVERTED, "state": "state[:8]"}),
    "berkeley_fanuc": Standard({"action": "action state[6:7]|invert", "joint_state": "state[:6]", "gripper_state": "state[6:7]"}),
    "cmu_playing_with_food": Standard({"action": "action[:3] action[3:7]|euler action[-1:]"}),
    "playfusion": Standard({"action": "action[:3] action[-4:]"}),
    "cmu_stretch": Standard({"action": "action[:-1]", "eef_state": "state[:3] 0*state[:3]", "gripper_state": "state[-1:]"}),
    "gnm": Standard({"action": "action 0*action 0*action 0*action[:1]", "state": "position 0*state[:3] yaw"}),
    "fmb": Standard({"proprio": "eef_pose state_gripper_pose"}),
    "dobbe": Standard({"proprio": "state"}),
    "roboset": Standard({"action": "action[:7] action[-1:]|clip|invert", "proprio": "state"}),
    "rh20t": Standard({"action": "action_tcp_base action_gripper", "proprio": "tcp_base gripper_width"}),
    "tdroid": Standard({"action": "action[:6] action[-1:]|binarize", "eef_state": "cartesian_position[:6]", "gripper_state": "gripper_position[-1:]"}),
    "libero": Standard({"action": "action[:6] action[-1:]|clip|invert", "eef_state": "state[:6]", "gripper_state": "state[-2:]"}),
    "aloha": Standard(),
}
#: Velocities in the robot's base frame, for DROID and its parts. Fixed values.
BASE_FRAME = Standard({"action": "cartesian_velocity[:6] action_gripper_position|invert", "proprio": "cartesian_position gripper_position"})
#: The ending of datasets that were brought to the common format by others.
CONVERTED = "_converted_externally_to_rlds"
#: The datasets' own names by the standard that they follow. Fixed values.
DATASETS: dict[str, str] = {
    "bridge_dataset": "bridge_orig",
    "ppgm_static": "ppgm",
    "ppgm_wrist": "ppgm",
    "fractal20220817_data": "rt1",
    "nyu_door_opening_surprising_effectiveness": "nyu_door_opening",
    "columbia_cairlab_pusht_real": "pusht",
    "stanford_kuka_multimodal_dataset" + CONVERTED: "stanford_kuka_multimodal",
    "nyu_rot_dataset" + CONVERTED: "nyu_rot",
    "stanford_hydra_dataset" + CONVERTED: "stanford_hydra",
    "austin_buds_dataset" + CONVERTED: "austin_buds",
    "nyu_franka_play_dataset" + CONVERTED: "nyu_franka_play",
    "maniskill_dataset" + CONVERTED: "maniskill",
    "furniture_bench_dataset" + CONVERTED: "furniture_bench",
    "cmu_franka_exploration_dataset" + CONVERTED: "cmu_franka_exploration",
    "ucsd_kitchen_dataset" + CONVERTED: "ucsd_kitchen",
    "ucsd_pick_and_place_dataset" + CONVERTED: "ucsd_pick_place",
    "austin_sailor_dataset" + CONVERTED: "austin_sailor",
    "austin_sirius_dataset" + CONVERTED: "austin_sirius",
    "utokyo_pr2_opening_fridge" + CONVERTED: "tokyo_pr2_opening_fridge",
    "utokyo_pr2_tabletop_manipulation" + CONVERTED: "tokyo_pr2_tabletop_manipulation",
    "utokyo_xarm_pick_and_place" + CONVERTED: "utokyo_xarm_pick_place",
    "utokyo_xarm_bimanual" + CONVERTED: "utokyo_xarm_bimanual",
    "berkeley_mvp" + CONVERTED: "berkeley_mvp",
    "berkeley_rpt" + CONVERTED: "berkeley_rpt",
    "kaist_nonprehensile" + CONVERTED: "kaist_nonprehensible",
    "stanford_mask_vit" + CONVERTED: "stanford_mask_vit",
    "tokyo_u_lsmo" + CONVERTED: "tokyo_lsmo",
    "dlr_sara_pour" + CONVERTED: "dlr_sara_pour",
    "dlr_sara_grid_clamp" + CONVERTED: "dlr_sara_grid_clamp",
    "dlr_edan_shared_control" + CONVERTED: "dlr_edan_shared_control",
    "asu_table_top" + CONVERTED: "asu_table_top",
    "stanford_robocook" + CONVERTED: "robocook",
    "imperialcollege_sawyer_wrist_cam": "imperial_wristcam",
    "iamlab_cmu_pickup_insert" + CONVERTED: "iamlab_pick_insert",
    "berkeley_fanuc_manipulation": "berkeley_fanuc",
    "cmu_play_fusion": "playfusion",
    "berkeley_gnm_recon": "gnm",
    "berkeley_gnm_cory_hall": "gnm",
    "berkeley_gnm_sac_son": "gnm",
    "fmb_dataset": "fmb",
    "tdroid_carrot_in_bowl": "tdroid",
    "tdroid_pour_corn_in_pot": "tdroid",
    "tdroid_flip_pot_upright": "tdroid",
    "tdroid_move_object_onto_plate": "tdroid",
    "tdroid_knock_object_over": "tdroid",
    "tdroid_cover_object_with_towel": "tdroid",
    "libero_spatial_no_noops": "libero",
    "libero_object_no_noops": "libero",
    "libero_goal_no_noops": "libero",
    "libero_10_no_noops": "libero",
    "libero_4_task_suites_no_noops": "libero",
    "aloha1_fold_shorts_20_demos": "aloha",
    "aloha1_fold_shirt_30_demos": "aloha",
    "aloha1_scoop_X_into_bowl_45_demos": "aloha",
    "aloha1_put_X_into_pot_300_demos": "aloha",
    "aloha_place_object_scale_builder": "aloha",
    "aloha_move_can_pot_builder": "aloha",
    "aloha_move_can_pot": "aloha",
    "aloha_put_object_cabinet": "aloha",
    "aloha_stack_bowls_three": "aloha",
    "aloha_blocks_ranking_rgb": "aloha",
    "aloha_place_dual_shoes": "aloha",
    "aloha_place_object_scale": "aloha",
    "aloha_stack_bowls_three_clean_builder": "aloha",
}


def inflate(packed: Column) -> Column:
    """Zlib-compressed 32-bit floats; Spark has no function for them."""

    def unpack(packed: pd.Series) -> pd.Series:
        return packed.map(lambda b: None if b is None else np.frombuffer(zlib.decompress(b), "<f4").astype(float).tolist())

    return F.pandas_udf(unpack, ArrayType(DoubleType()))(packed)


def _numbers(df: DataFrame, column: str) -> Column:
    """The column as an array of doubles; a single number is an array of one."""
    kind = df.schema[column].dataType
    if isinstance(kind, BinaryType):
        return F.col(column)
    return F.col(column).cast("array<double>") if isinstance(kind, ArrayType) else F.array(F.col(column).cast("double"))


def _cut(values: Column, begin: str | None, end: str | None) -> Column:
    """values[begin:end] of an array, with Python's meaning of missing and negative ends."""
    if not begin and not end:
        return values
    n = F.size(values)
    place = lambda text, default: default if not text else F.lit(int(text)) if int(text) >= 0 else F.greatest(n + int(text), F.lit(0))
    first, last = place(begin, F.lit(0)), F.least(place(end, n), n)
    return F.slice(values, first + 1, F.greatest(last - first, F.lit(0)))


#: What columns of standardize()'s own begin with.
OWN = "__standard_"


def _vector(df: DataFrame, name: str, pieces: str) -> tuple[DataFrame, Column]:
    """df, with columns of its own as needed, and the array put together from the pieces."""
    found = []
    for k, text in enumerate(pieces.split()):
        m = PIECE.fullmatch(text)
        if m is None:
            raise ValueError(f"not a piece: {text}")
        values = _cut(_numbers(df, m["column"]), m["begin"], m["end"])
        if m["fill"]:
            values = F.array_repeat(F.lit(float(m["fill"])), F.size(values))
        for change in filter(None, m["changes"].split("|")):
            if change in CHANGES:
                values = F.transform(values, CHANGES[change])
            elif change == "euler":
                values = geometry.convert_rotation(F.array(*[F.get(values, F.lit(i)) for i in (3, 0, 1, 2)]), "quaternion", "euler")
            elif change == "inflate":
                values = inflate(values)
            elif change in RELABELS:
                own = f"{OWN}{name}_{k}"
                df = df.withColumn(own, F.get(values, F.lit(0))).withColumnsRenamed({"gripper": f"{OWN}gripper"})
                df = RELABELS[change](df, own).withColumn(own, F.col("gripper")).drop("gripper").withColumnsRenamed({f"{OWN}gripper": "gripper"})
                values = F.array(own)
            else:
                raise ValueError(f"no change {change}")
        found.append(values)
    return df, F.concat(*found)


def _text(df: DataFrame, column: str) -> Column:
    """The column up to the first zero character; an array is a text's code points."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, ArrayType):
        codes = F.transform(value.cast("array<int>"), lambda c: F.lpad(F.hex(c), 8, "0"))
        value = F.decode(F.unhex(F.array_join(codes, "")), "UTF-32")
    return F.substring_index(value, "\0", 1)


def standardize(df: DataFrame, standard: Standard) -> DataFrame:
    """Frames (ep, idx, further columns) as the standard says; columns that it does not name stay.

    Null values give null elements. A frame goes only for its place (drop_first, reached), never for a null.
    """
    rows = df.where("idx > 0").withColumn("idx", F.col("idx") - 1) if standard.drop_first else df
    made = {}
    for name, pieces in standard.vectors.items():
        rows, made[name] = _vector(rows, name, pieces)
    if standard.instruction:
        made["language_instruction"] = _text(rows, standard.instruction)
    rows = rows.withColumns(made) if made else rows
    for name, source in standard.depth.items():
        column = source.removesuffix("[0]")
        if column in rows.columns:
            image = F.transform(column, lambda line: F.transform(line, lambda pixel: F.get(pixel, F.lit(0)).cast("float"))) if column != source else F.col(column)
            rows = rows.withColumn(name, image)
            rows = rows.drop(column) if column != name else rows
    if standard.reached:
        w = windows.in_order()
        nearer = F.zip_with(F.slice(F.lead("state").over(w), 1, 6), F.slice("state", 1, 6), lambda b, a: b - a)
        rows = rows.withColumns({f"{OWN}way": nearer, f"{OWN}next": F.lead("idx").over(w)}).where(F.col(f"{OWN}next").isNotNull())
        rows = rows.withColumn("action", F.concat(F.coalesce(f"{OWN}way", F.array_repeat(F.lit(None).cast("double"), 6)), F.slice("action", 7, 1)))
    return rows.drop(*[c for c in rows.columns if c.startswith(OWN)])


for _name, _standard in (STANDARDS | {name: STANDARDS[own] for name, own in DATASETS.items()} | {"droid": BASE_FRAME, "droid_wipe": BASE_FRAME}).items():
    register(_name)(lambda df, s=_standard: standardize(df, s))


def restructure(df: DataFrame, images: dict[str, str | None], proprio: dict[str | None, int], text: str | None, dataset: str) -> DataFrame:
    """Observation keys image_<name>, proprio concatenated from the columns (zeros of the given length for None),
    timestep, the instruction and the dataset's name. An image of None is padding, an empty text."""
    state = F.concat(*[F.array_repeat(F.lit(0.0), n) if c is None else F.col(c) for c, n in proprio.items()])
    step = (F.row_number().over(Window.partitionBy("ep").orderBy("idx")) - 1).cast("long")
    shown = [(F.lit("") if c is None else F.col(c)).alias(f"image_{name}") for name, c in images.items()]
    return df.select("ep", "idx", *shown, state.alias("proprio"), step.alias("timestep"), (F.lit(None).cast("string") if text is None else F.col(text)).alias("instruction"), F.lit(dataset).alias("dataset_name"))


def repack(df: DataFrame, structure: dict) -> DataFrame:
    """Columns by a nested dict of names to paths."""

    def build(node: dict | str) -> Column:
        return F.col(node) if isinstance(node, str) else F.struct(*[build(v).alias(k) for k, v in node.items()])

    return df.select(*[build(v).alias(k) for k, v in structure.items()])
