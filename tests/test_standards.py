"""Every standard's values, worked out on plain lists, and all names of the registry."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodia.operators import transforms
from episodia.operators.transforms import BASE_FRAME, DATASETS, STANDARDS

N = 4
GRIP = [0.99, 0.5, 0.01, 0.4]  # decided, open, decided, undecided


def frame(t):
    """One frame; all names that any standard reads."""
    a = [round(0.01 * (i + 1) + 0.1 * t, 6) for i in range(10)]
    q = [0.0, 0.0, math.sin(0.1 * (t + 1)), math.cos(0.1 * (t + 1))]
    return {
        "action": [*a[:3], *q, *a[7:9], GRIP[t]],
        "state": [round(0.02 * (i + 1) - 0.1 * t, 6) for i in range(15)],
        "world_vector": a[:3], "rotation_delta": a[3:6], "open_gripper": GRIP[t], "gripper_closedness_action": [GRIP[t] - 0.5],
        "rel_actions_world": [*a[:6], 1.7 - t], "robot_obs": a[:9], "end_effector_cartesian_pos": a[:7], "end_effector_pose": a[:8], "robot_state": [*a, *a],
        "cartesian_position": a[:6], "gripper_position": [GRIP[t]], "cartesian_velocity": a[:7], "action_gripper_position": [GRIP[t]],
        "xyz_residual": a, "axis_angle_residual": a, "target_close": [GRIP[t], 0.0], "ground_truth_ee": a[:6], "position": a[:2], "yaw": a[2:3],
        "eef_pose": a[:7], "state_gripper_pose": GRIP[t], "action_tcp_base": a[:6], "action_gripper": GRIP[t], "tcp_base": a[3:9], "gripper_width": 0.25,
        "base_pose_tool_reached": zlib.compress(np.array(a[:7], "<f4").tobytes()), "gripper_closed": zlib.compress(np.array([GRIP[t]], "<f4").tobytes()),
        "natural_language_instruction": f"do {t}", "instruction": "push\0\0",
    }


FRAMES = [frame(t) for t in range(N)]
inverted = lambda x: 1 - min(max(x, 0.0), 1.0)
turn = lambda f: [0.0, 0.0, 2 * math.atan2(f["action"][5], f["action"][6])]
BINARY = [1.0, 0.0, 0.0, 0.4]  # an open place takes the next decision, the last ones the raw value
STRONG = [-1.0, -1.0, 1.0, 1.0]  # 0.49 closes, -0.49 opens, weak moves keep
ABSOLUTE = [s / 2 + 0.5 for s in STRONG]


def moves(f, last):
    return [*f["world_vector"], *f["rotation_delta"], *last]


def reads(name, *cuts):
    """A vector put together from parts of one."""
    return lambda f, t: [x for a, b in cuts for x in f[name][a:b]]


STATE6 = {"eef_state": reads("state", (0, 6)), "gripper_state": reads("state", (14, 15))}
BUT_LAST = {"action": reads("action", (0, 9))}
TURNED = {"action": lambda f, t: [*f["action"][:6], inverted(f["action"][9])]}
SIX_BINARY = {"action": lambda f, t: [*f["action"][:6], BINARY[t]], "eef_state": reads("cartesian_position", (0, 6)), "gripper_state": reads("gripper_position", (0, 1))}
ABS = {"action": lambda f, t: moves(f, [ABSOLUTE[t]])}
OPEN = {"action": lambda f, t: moves(f, [f["open_gripper"]])}
CLOSED = {"action": lambda f, t: moves(f, [inverted(f["gripper_closedness_action"][0])])}
FLAT = {"action": lambda f, t: [*f["action"][:4], 0, 0, f["action"][9]]}

WANTED = {
    "ppgm": SIX_BINARY, "tdroid": SIX_BINARY, "rt1": ABS, "nyu_door_opening": ABS, "toto": OPEN, "roboturk": CLOSED, "viola": CLOSED,
    "kuka": ABS | {"base_pose_tool_reached": reads("world_vector", (0, 3), (0, 0)), "gripper_closed": lambda f, t: [f["open_gripper"]]},
    "taco_play": {"action": lambda f, t: [*f["rel_actions_world"][:6], min(max(1.7 - t, 0.0), 1.0)], "state_eef": reads("robot_obs", (0, 6)), "state_gripper": reads("robot_obs", (7, 8))},
    "jaco_play": {"action": lambda f, t: [*f["world_vector"], 0, 0, 0, ABSOLUTE[t]], "state_eef": reads("end_effector_cartesian_pos", (0, 6)), "state_gripper": reads("end_effector_cartesian_pos", (6, 7))},
    "berkeley_cable_routing": {"action": lambda f, t: moves(f, [0.0])},
    "berkeley_autolab_ur5": ABS | {"state": reads("robot_state", (6, 14))},
    "language_table": {"action": lambda f, t: [*f["action"], *[0] * 20, 1]},
    "pusht": {"action": lambda f, t: moves(f, f["gripper_closedness_action"])},
    "stanford_kuka_multimodal": {"action": lambda f, t: [*f["action"][:3], 0, 0, 0, f["action"][9]]},
    "nyu_rot": {"action": reads("action", (0, 7)), **STATE6},
    "stanford_hydra": {"action": lambda f, t: [*f["action"][:6], 1 - f["action"][9]], "eef_state": reads("state", (0, 3), (7, 10)), "gripper_state": reads("state", (12, 13))},
    "austin_buds": TURNED | {"state": reads("state", (0, 8))}, "utaustin_mutex": TURNED | {"state": reads("state", (0, 8))}, "austin_sailor": TURNED, "austin_sirius": TURNED,
    "nyu_franka_play": {"action": lambda f, t: [*f["action"][2:8], min(max(f["action"][8], 0.0), 1.0)], "eef_state": reads("state", (9, 15))},
    "maniskill": {"gripper_state": reads("state", (7, 8))},
    "furniture_bench": {"action": lambda f, t: [*f["action"][:3], *turn(f), inverted(f["action"][9])], "state": reads("state", (0, 7), (14, 15))},
    "cmu_franka_exploration": BUT_LAST, "imperial_wristcam": BUT_LAST, "ucsd_kitchen": BUT_LAST | {"joint_state": reads("state", (0, 7))},
    "ucsd_pick_place": {"action": lambda f, t: [*f["action"][:3], 0, 0, 0, f["action"][9]], **STATE6},
    "bc_z": {"action": lambda f, t: [*f["xyz_residual"][:3], *f["axis_angle_residual"][:3], 1 - f["target_close"][0]]},
    "tokyo_pr2_opening_fridge": BUT_LAST | STATE6, "tokyo_pr2_tabletop_manipulation": BUT_LAST | STATE6, "utokyo_xarm_pick_place": {}, "utokyo_xarm_bimanual": {"action": reads("action", (3, 10))},
    "robo_net": FLAT | {"eef_state": lambda f, t: [*f["state"][:4], 0, 0], "gripper_state": reads("state", (14, 15))},
    "berkeley_mvp": {}, "berkeley_rpt": {}, "kaist_nonprehensible": {"action": lambda f, t: [*f["action"][:6], 0], "state": reads("state", (8, 15))},
    "stanford_mask_vit": FLAT | {"eef_state": lambda f, t: [*f["end_effector_pose"][:4], 0, 0], "gripper_state": reads("end_effector_pose", (7, 8))},
    "tokyo_lsmo": STATE6, "robocook": STATE6, "dlr_sara_pour": {}, "dlr_sara_grid_clamp": {"state": reads("state", (0, 6))},
    "dlr_edan_shared_control": {"action": lambda f, t: [*f["action"][:6], 1 - f["action"][9]]},
    "asu_table_top": {"eef_state": reads("ground_truth_ee", (0, 6)), "gripper_state": reads("state", (14, 15))},
    "iamlab_pick_insert": {"action": lambda f, t: [*f["action"][:3], *turn(f), f["action"][7]], "joint_state": reads("state", (0, 7)), "gripper_state": reads("state", (7, 8))},
    "uiuc_d3field": {"action": lambda f, t: [*f["action"], *[0] * 11]},
    "berkeley_fanuc": {"action": lambda f, t: [*f["action"], 1 - f["state"][6]], "joint_state": reads("state", (0, 6)), "gripper_state": reads("state", (6, 7))},
    "cmu_playing_with_food": {"action": lambda f, t: [*f["action"][:3], *turn(f), f["action"][9]]},
    "playfusion": {"action": reads("action", (0, 3), (6, 10))},
    "cmu_stretch": BUT_LAST | {"eef_state": lambda f, t: [*f["state"][:3], 0, 0, 0], "gripper_state": reads("state", (14, 15))},
    "gnm": {"action": lambda f, t: [*f["action"], *[0] * 21], "state": lambda f, t: [*f["position"], 0, 0, 0, *f["yaw"]]},
    "fmb": {"proprio": lambda f, t: [*f["eef_pose"], f["state_gripper_pose"]]}, "dobbe": {"proprio": reads("state", (0, 15))},
    "roboset": {"action": lambda f, t: [*f["action"][:7], inverted(f["action"][9])], "proprio": reads("state", (0, 15))},
    "rh20t": {"action": lambda f, t: [*f["action_tcp_base"], f["action_gripper"]], "proprio": lambda f, t: [*f["tcp_base"], 0.25]},
    "libero": TURNED | {"eef_state": reads("state", (0, 6)), "gripper_state": reads("state", (13, 15))}, "aloha": {},
    "droid": {"action": lambda f, t: [*f["cartesian_velocity"][:6], 1 - GRIP[t]], "proprio": lambda f, t: [*f["cartesian_position"], GRIP[t]]},
}
WANTED["kuka"]["base_pose_tool_reached"] = reads("robot_state", (0, 7))
ALL = STANDARDS | {"droid": BASE_FRAME}
TEXTS = {name: s.instruction for name, s in STANDARDS.items() if s.instruction}


@pytest.fixture(scope="module")
def frames(spark):
    kinds = {str: "string", bytes: "binary", float: "double", list: "array<double>"}
    schema = "ep long, idx long, _own int, " + ", ".join(f"{k} {kinds[type(v)]}" for k, v in FRAMES[0].items())
    return spark.createDataFrame([(1, t, 7, *f.values()) for t, f in enumerate(FRAMES)], schema).cache()


@pytest.mark.parametrize("name", sorted(ALL))
def test_values(frames, name):
    got = transforms.named(name)(frames).orderBy("idx").collect()
    assert all(r._own == 7 for r in got)  # users' columns stay, whatever they begin with
    if ALL[name].drop_first:
        assert [r.idx for r in got] == list(range(N - 2))
        for r in got:
            here, there = FRAMES[r.idx + 1], FRAMES[r.idx + 2]
            way = [b - a for a, b in zip(here["state"][:6], there["state"][:6], strict=True)]
            last = here["open_gripper"] if name == "bridge_oxe" else [0.0, 0.0, 0.4][r.idx]
            assert r.action == pytest.approx([*way, last]) and r.eef_state == pytest.approx(here["state"][:6]) and r.gripper_state == pytest.approx(here["state"][-1:])
        return
    assert len(got) == N
    for t, r in enumerate(got):
        for column, want in WANTED[name].items():
            assert r[column] == pytest.approx(want(FRAMES[t], t), abs=1e-6), (column, t)
        untouched = {"action", "state"} - WANTED[name].keys()
        assert all(r[c] == pytest.approx(FRAMES[t][c]) for c in untouched)
        if name in TEXTS:
            assert r.language_instruction == ("push" if name == "language_table" else f"do {t}")


def test_registry_names():
    assert len(STANDARDS) == 59 and set(DATASETS.values()) <= set(STANDARDS)
    for name in ("fractal20220817_data", "bridge_dataset", "libero_spatial_no_noops", "utokyo_xarm_bimanual_converted_externally_to_rlds", "droid_wipe", "aloha_stack_bowls_three_clean_builder", "kuka"):
        transforms.named(name)
    with pytest.raises(KeyError, match="no transform nothing"):
        transforms.named("nothing")


def test_texts_of_code_points_depth_images_and_null_states(spark, frames):
    codes = frames.withColumn("instruction", F.expr("array(112, 252, 116510, 0, 0)"))
    assert {r.language_instruction for r in transforms.named("language_table")(codes).collect()} == {"pü\U0001c71e"}
    image = F.expr("array(array(array(1, 2), array(3, 4)))")
    play = transforms.named("nyu_franka_play")(frames.withColumn("depth", image)).first()
    assert play.depth == [[1.0, 3.0]]
    ur5 = transforms.named("berkeley_autolab_ur5")(frames.withColumn("image_with_depth", image))
    assert ur5.first().depth == [[[1, 2], [3, 4]]] and "image_with_depth" not in ur5.columns
    holed = frames.withColumn("state", F.when(F.col("idx") != 2, F.col("state")))
    got = transforms.named("bridge_orig")(holed).orderBy("idx").collect()
    assert [r.idx for r in got] == [0, 1] and all(r.action[:6] == [None] * 6 for r in got)
