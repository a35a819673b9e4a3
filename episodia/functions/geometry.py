"""Rigid geometry on columns (survey rows G1-G21). A matrix is a tuple of rows of columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = tuple[Column, ...]


def quaternion_matrix(w: Column, x: Column, y: Column, z: Column) -> tuple[Vector, Vector, Vector]:
    """G1: rotation matrix of a quaternion, normalized first; a norm of 0 is an error."""
    norm = F.sqrt(w * w + x * x + y * y + z * z)
    n = F.when(norm > 0, norm).otherwise(F.raise_error(F.lit("quaternion norm must be positive")).cast("double"))
    w, x, y, z = w / n, x / n, y / n, z / n
    return (
        (1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)),
        (2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)),
        (2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)),
    )


def rotate(matrix: tuple[Vector, Vector, Vector], p: Vector) -> Vector:
    return tuple(sum((m * c for m, c in zip(row[1:], p[1:], strict=True)), row[0] * p[0]) for row in matrix)


def transform_point(matrix: tuple[Vector, Vector, Vector], shift: Vector, p: Vector) -> Vector:
    """G4."""
    return tuple(r + s for r, s in zip(rotate(matrix, p), shift, strict=True))


def to_local(matrix: tuple[Vector, Vector, Vector], shift: Vector, p: Vector) -> Vector:
    """G5 for rigid poses: the transposed rotation of the shifted point."""
    columns = tuple(zip(*matrix, strict=True))
    return rotate(columns, tuple(c - s for c, s in zip(p, shift, strict=True)))


def unit(v: Vector, eps: float = 1e-9) -> Vector:
    """The vector of length 1, or zeros for lengths up to eps."""
    norm = F.sqrt(sum((c * c for c in v[1:]), v[0] * v[0]))
    return tuple(F.when(norm > eps, c / F.when(norm > eps, norm).otherwise(1.0)).otherwise(0.0) for c in v)


def quaternion_angle(w: Column) -> Column:
    """Rotation angle of a unit quaternion as a fraction of pi."""
    return 2 * F.acos(F.least(F.abs(w), F.lit(1.0))) / F.pi()


def six_d_rotation(a: Vector, b: Vector) -> tuple[Vector, Vector, Vector]:
    """Rotation rows from two vectors, by Gram-Schmidt."""
    v = _six_d_array((*a, *b))
    m = [F.get(v, F.lit(i)) for i in range(9)]
    return tuple(m[:3]), tuple(m[3:6]), tuple(m[6:])


def _six_d_array(v: Vector) -> Column:
    v = bound(F.array(*v), 6, lambda v: (*unit(v[:3]), *v[3:]))
    v = bound(v, 6, lambda v: (*v[:3], *[q - dot(v[:3], v[3:]) * p for p, q in zip(v[:3], v[3:], strict=True)]))
    v = bound(v, 6, lambda v: (*v[:3], *unit(v[3:])))
    return bound(v, 6, lambda v: (*v, *cross(v[:3], v[3:])))


def _flat(m: tuple[Vector, ...]) -> Vector:
    return tuple(c for row in m for c in row)


def to_byte(c: Column) -> Column:
    """A colour in [0, 1] as 0..255, truncated."""
    return (F.greatest(F.least(c, F.lit(1.0)), F.lit(0.0)) * 255).cast("int")


def facing(normal: Vector, point: Vector, camera: Vector) -> Vector:
    """A given normal at length 1, turned to the side of the camera."""
    n = unit(normal)
    toward = sum((a * (c - p) for a, p, c in zip(n[1:], point[1:], camera[1:], strict=True)), n[0] * (camera[0] - point[0]))
    return tuple(F.when(toward < 0, -c).otherwise(c) for c in n)


def rotation_distance(p: Vector, q: Vector) -> Column:
    """The angle, in radians, of the rotation between two unit quaternions."""
    dot = sum((a * b for a, b in zip(p[1:], q[1:], strict=True)), p[0] * q[0])
    return 2 * F.acos(F.least(F.abs(dot), F.lit(1.0)))


def to_wrist(matrix: tuple[Vector, Vector, Vector], velocity: Vector) -> Vector:
    """A velocity of the base frame in the frame of the wrist that `matrix` turns."""
    return rotate(tuple(zip(*matrix, strict=True)), velocity)


def full_range(c: Column, top: Column) -> Column:
    """Colours of a cloud whose largest value is at most 1, scaled to 255; others as they are."""
    return F.when(top <= 1, c * 255).otherwise(c)


def dot(a: Vector, b: Vector) -> Column:
    return sum((p * q for p, q in zip(a[1:], b[1:], strict=True)), a[0] * b[0])


def cross(a: Vector, b: Vector) -> Vector:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def matmul(a: tuple[Vector, ...], b: tuple[Vector, ...]) -> tuple[Vector, ...]:
    """The product of two matrices of columns."""
    return tuple(tuple(dot(row, column) for column in zip(*b, strict=True)) for row in a)


def pose_matrix(position: Vector, quaternion: Vector, order: str = "wxyz") -> tuple[Vector, ...]:
    """The 4 x 4 matrix of a position and a quaternion in either order of components."""
    w, x, y, z = quaternion if order == "wxyz" else (quaternion[3], *quaternion[:3])
    rows = quaternion_matrix(w, x, y, z)
    zero, one = F.lit(0.0), F.lit(1.0)
    return (*[(*row, t) for row, t in zip(rows, position, strict=True)], (zero, zero, zero, one))


def bound(values: Column, size: int, body: Callable[[Vector], Vector | Column]) -> Column:
    """The array that body makes of an array's elements, which it may name any number of times: the expression holds them once."""

    def array_of(a: Column) -> Column:
        made = body(tuple(F.get(a, F.lit(i)) for i in range(size)))
        return made if isinstance(made, Column) else F.array(*made)

    return F.transform(F.array(values), array_of)[0]


def matrix_quaternion(m: tuple[Vector, ...]) -> Vector:
    """(x, y, z, w) of a rotation matrix, from its largest diagonal term: the trace if that is positive, else one of the three."""
    q = _quaternion_array(m)
    return tuple(F.get(q, F.lit(i)) for i in range(4))


def _quaternion_array(m: tuple[Vector, ...]) -> Column:
    def largest(a: Vector) -> Vector:
        m = a[:3], a[3:6], a[6:]
        trace = m[0][0] + m[1][1] + m[2][2]
        spread = lambda t: F.sqrt(F.greatest(t, F.lit(0.0))) * 2
        s = [spread(1 + trace), spread(1 + m[0][0] - m[1][1] - m[2][2]), spread(1 + m[1][1] - m[0][0] - m[2][2]), spread(1 + m[2][2] - m[0][0] - m[1][1])]
        yz, zx, xy = m[2][1] - m[1][2], m[0][2] - m[2][0], m[1][0] - m[0][1]
        sum_xy, sum_zx, sum_yz = m[0][1] + m[1][0], m[0][2] + m[2][0], m[1][2] + m[2][1]
        cases = [(yz, zx, xy, s[0] * s[0] / 4), (s[1] * s[1] / 4, sum_xy, sum_zx, yz), (sum_xy, s[2] * s[2] / 4, sum_yz, zx), (sum_zx, sum_yz, s[3] * s[3] / 4, xy)]
        first, second = (m[0][0] > m[1][1]) & (m[0][0] > m[2][2]), m[1][1] > m[2][2]
        return tuple(F.when(trace > 0, a / s[0]).when(first, b / s[1]).when(second, c / s[2]).otherwise(d / s[3]) for a, b, c, d in zip(*cases, strict=True))

    q = bound(F.array(*[c for row in m for c in row[:3]]), 9, largest)
    return bound(q, 4, lambda c: tuple(x / F.sqrt(dot(c, c)) for x in c))


def rigid_inverse(m: tuple[Vector, ...]) -> tuple[Vector, ...]:
    """The inverse of a rigid 4 x 4 matrix."""
    turned = tuple(zip(*[row[:3] for row in m[:3]], strict=True))
    shift = tuple(-c for c in rotate(turned, tuple(row[3] for row in m[:3])))
    return (*[(*row, t) for row, t in zip(turned, shift, strict=True)], m[3])


def homogeneous(m: tuple[Vector, ...]) -> tuple[Vector, ...]:
    """A 3 x 4 extrinsic matrix as 4 x 4; one of 4 x 4 as it is."""
    return m if len(m) == 4 else (*m, (F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)))


def scaled_intrinsic(fx: Column, cx: Column, fy: Column, cy: Column, width: Column, height: Column, to: tuple[int, int] = (180, 320)) -> tuple[Column, Column, Column, Column]:
    """Focal lengths and centre of an image of width x height, for one of `to` = (rows, columns)."""
    x, y = F.lit(float(to[1])) / width, F.lit(float(to[0])) / height
    return fx * x, cx * x, fy * y, cy * y


def rebase(base0: tuple[Vector, ...], pose: tuple[Vector, ...]) -> tuple[Vector, ...]:
    """A world pose in the frame of the robot's base at frame 0."""
    return matmul(rigid_inverse(base0), pose)


def slerp(p: Vector, q: Vector, t: Column) -> Vector:
    """Between unit quaternions of any order of components, the shorter way; nearly equal ones are mixed linearly and made a unit again."""
    cosine = dot(p, q)
    sign, cosine = F.when(cosine < 0, -1.0).otherwise(1.0), F.least(F.abs(cosine), F.lit(1.0))
    angle, near = F.acos(cosine), cosine > 0.9999995
    sine = F.when(near, 1.0).otherwise(F.sin(angle))
    a = F.when(near, 1 - t).otherwise(F.sin((1 - t) * angle) / sine)
    b = F.when(near, t).otherwise(F.sin(t * angle) / sine) * sign
    mixed = tuple(x * a + y * b for x, y in zip(p, q, strict=True))
    norm = F.sqrt(dot(mixed, mixed))
    return tuple(c / norm for c in mixed)


def euler_matrix(x: Column, y: Column, z: Column) -> tuple[Vector, Vector, Vector]:
    """The rotation about x, then y, then z, all axes fixed."""
    (cx, sx), (cy, sy), (cz, sz) = ((F.cos(a), F.sin(a)) for a in (x, y, z))
    return ((cy * cz, sx * sy * cz - cx * sz, cx * sy * cz + sx * sz), (cy * sz, sx * sy * sz + cx * cz, cx * sy * sz - sx * cz), (-sy, sx * cy, cx * cy))


def matrix_euler(m: tuple[Vector, ...]) -> Vector:
    """(x, y, z) of euler_matrix(), y within a right angle either way."""
    return F.atan2(m[2][1], m[2][2]), F.asin(F.least(F.greatest(-m[2][0], F.lit(-1.0)), F.lit(1.0))), F.atan2(m[1][0], m[0][0])


def axis_angle_matrix(x: Column, y: Column, z: Column) -> tuple[Vector, Vector, Vector]:
    """The rotation by the vector's length about its direction."""
    angle = F.sqrt(x * x + y * y + z * z)
    s = F.when(angle > 1e-12, F.sin(angle / 2) / F.when(angle > 1e-12, angle).otherwise(1.0)).otherwise(0.5)
    return quaternion_matrix(F.cos(angle / 2), x * s, y * s, z * s)


def matrix_axis_angle(m: tuple[Vector, ...]) -> Column:
    """The rotation vector as an array, at most half a turn long."""

    def vector(q: Vector) -> Vector:
        flip = F.when(q[3] < 0, -1.0).otherwise(1.0)
        length = F.sqrt(dot(q[:3], q[:3]))
        factor = F.when(length > 1e-12, 2 * F.atan2(length, q[3] * flip) / F.when(length > 1e-12, length).otherwise(1.0)).otherwise(2.0) * flip
        return tuple(c * factor for c in q[:3])

    return bound(_quaternion_array(m), 4, vector)


#: Name -> (number of components, to the nine numbers of a matrix, from a matrix)
ROTATIONS = {
    "quaternion": (4, lambda v: _flat(quaternion_matrix(*v)), lambda m: bound(_quaternion_array(m), 4, lambda q: (q[3], *q[:3]))),
    "rotation_6d": (6, lambda v: _six_d_array(v), lambda m: (*m[0], *m[1])),
    "euler": (3, lambda v: _flat(euler_matrix(*v)), matrix_euler),
    "axis_angle": (3, lambda v: _flat(axis_angle_matrix(*v)), matrix_axis_angle),
    "matrix": (9, lambda v: v, lambda m: (*m[0], *m[1], *m[2])),
}


def convert_rotation(v: Column, source: str, target: str) -> Column:
    """An array of one representation as an array of another, always by way of the matrix."""
    size, to_matrix, _ = ROTATIONS[source]
    matrix = bound(v, size, to_matrix)
    return bound(matrix, 9, lambda m: ROTATIONS[target][2]((m[:3], m[3:6], m[6:])))


def palette_color(label: Column, colors: list[tuple[int, int, int]]) -> Column:
    """The colour of a label, which wraps at 256; null beyond the palette."""
    table = F.array(*[F.struct(*[F.lit(c).alias(n) for c, n in zip(color, "rgb", strict=True)]) for color in colors])
    return F.get(table, F.pmod(label, F.lit(256)).cast("int"))


def length(v: Vector) -> Column:
    return F.sqrt(dot(v, v))


def rotation_about(axis: Vector, angle: Column) -> tuple[Vector, Vector, Vector]:
    """The turn by `angle` about an axis, which counts by its direction."""
    n = length(axis)
    a = tuple(c / F.when(n > 0, n) for c in axis)
    c, s = F.cos(angle), F.sin(angle)
    zero = F.lit(0.0)
    side = ((zero, -a[2], a[1]), (a[2], zero, -a[0]), (-a[1], a[0], zero))
    return tuple(tuple((c if i == j else zero) + a[i] * a[j] * (1 - c) + s * side[i][j] for j in range(3)) for i in range(3))


def aligning_rotation(a: Vector, b: Vector, turn_back: bool = False) -> Column:
    """The rotation that turns a's direction into b's, as an array of nine.

    Directions that are nearly parallel need none, and opposite ones get none either, as their axis is not defined; with
    turn_back they get a half turn about an axis at a right angle to a. Vectors of length 0 give nulls.
    """

    def rotation(v: Vector) -> Vector:
        p, q = v[:3], v[3:]
        axis = cross(p, q)
        turned = rotation_about(axis, F.acos(F.greatest(F.least(dot(p, q), F.lit(1.0)), F.lit(-1.0))))
        same = tuple(F.lit(1.0 if i % 4 == 0 else 0.0) for i in range(9))
        # at a right angle to p: the cross product with x, or with y if p is nearly x itself
        steep = F.abs(p[0]) > 0.9
        side = cross(p, (F.when(steep, 0.0).otherwise(1.0), F.when(steep, 1.0).otherwise(0.0), F.lit(0.0)))
        back = _flat(rotation_about(side, F.pi()))
        small = length(axis) < 1e-6
        still = [F.when(dot(p, q) < 0, y).otherwise(x) for x, y in zip(same, back, strict=True)] if turn_back else same
        return tuple(F.when(p[0].isNull() | q[0].isNull(), F.lit(None)).when(small, x).otherwise(m) for x, m in zip(still, _flat(turned), strict=True))

    norms = [F.when(length(v) > 0, length(v)) for v in (a, b)]
    return bound(F.array(*[c / norms[0] for c in a], *[c / norms[1] for c in b]), 6, rotation)


def projection(onto: Vector, v: Vector) -> Vector:
    """The part of v that lies along `onto`; nulls if that has no length."""
    square = dot(onto, onto)
    return tuple(dot(onto, v) / F.when(square > 0, square) * c for c in onto)


def facing_frame(eye: Vector, origin: Vector, up: Vector) -> tuple[Vector, Vector, Vector]:
    """The rotation whose x axis points from eye to origin and whose z axis is as near to `up` as can be; axes are its columns."""
    x = unit(tuple(o - e for o, e in zip(origin, eye, strict=True)))
    z = unit(tuple(u - dot(x, up) * c for u, c in zip(up, x, strict=True)))
    y = cross(z, x)
    return tuple(zip(x, y, z, strict=True))


def placement(actor: tuple[Vector, ...], target: tuple[Vector, ...], upright: bool = True) -> Column:
    """A pose at the target's place whose up direction is the target's z axis, turned there the shortest way, as an array of 12
    (three rows of four). The actor's up is its own y axis with upright, else its z axis."""
    up = tuple(row[1 if upright else 2] for row in actor[:3])

    def pose(m: Vector) -> Vector:
        turned = matmul((m[:3], m[3:6], m[6:9]), tuple(tuple(row[:3]) for row in actor[:3]))
        return tuple(c for row, place in zip(turned, target, strict=False) for c in (*row, place[3]))

    return bound(aligning_rotation(up, tuple(row[2] for row in target[:3])), 9, pose)



def orbit(target: tuple[Vector, ...], center: tuple[Vector, ...], axis: Vector, angle: Column, frame: str = "center", towards: Vector | None = None, up: Vector | None = None) -> Column:
    """A pose carried round another one's place by `angle` about an axis, as an array of 12 (three rows of four).

    The axis is given in the frame of the center, of the target, or of the world. With towards the turn goes the other way
    if it would lead to a place against that direction, seen from the center. The pose turns as it goes, or, with up, it
    faces the center (see facing_frame()).
    """
    if frame not in ("center", "target", "world"):
        raise ValueError("an axis is given in the frame of the center, the target or the world")
    own = {"center": center, "target": target}.get(frame)
    about = rotate(tuple(tuple(row[:3]) for row in own[:3]), axis) if own else axis
    middle, start = (tuple(row[3] for row in m[:3]) for m in (center, target))
    arm = tuple(s - c for s, c in zip(start, middle, strict=True))
    turns = [rotation_about(about, angle), rotation_about(about, -angle)]
    chosen = F.array(*_flat(turns[0]))
    if towards is not None:
        chosen = F.when(dot(rotate(turns[0], arm), towards) < 0, F.array(*_flat(turns[1]))).otherwise(chosen)

    def pose(m: Vector) -> Vector:
        turn = (m[:3], m[3:6], m[6:9])
        place = tuple(r + c for r, c in zip(rotate(turn, arm), middle, strict=True))
        rows = facing_frame(place, middle, up) if up is not None else matmul(turn, tuple(tuple(row[:3]) for row in target[:3]))
        return tuple(c for row, p in zip(rows, place, strict=True) for c in (*row, p))

    return bound(chosen, 9, pose)


def aligned_placement(actor: tuple[Vector, ...], target: tuple[Vector, ...], axes: list[Vector], own_axis: Vector, upright: bool = True) -> Column:
    """placement(), then turned about the target's z axis until the actor's own axis points, seen in the target's plane, where
    the one of the given world axes does that it was nearest to; as an array of 12. The first of equal axes counts."""

    def shown_and_nearest(m: Vector) -> Vector:
        shown = rotate((m[0:3], m[4:7], m[8:11]), own_axis)
        products = F.array(*[dot(shown, unit(a)) for a in axes])
        nearest = F.get(F.array(*[F.array(*a) for a in axes]), F.array_position(products, F.array_max(products)).cast("int") - 1)
        return (*m, *shown, *[F.get(nearest, F.lit(i)) for i in range(3)])

    def in_plane(m: Vector) -> Vector:
        plane = [tuple(row[k] for row in target[:3]) for k in (0, 1)]
        flat = lambda v: tuple(a + b for a, b in zip(projection(plane[0], v), projection(plane[1], v), strict=True))
        return (*m[:12], *flat(m[12:15]), *flat(m[15:18]))

    def with_turn(m: Vector) -> Column:
        return F.concat(F.array(*m[:12]), aligning_rotation(m[12:15], m[15:18]))

    def pose(m: Vector) -> Vector:
        rows = matmul((m[12:15], m[15:18], m[18:21]), (m[0:3], m[4:7], m[8:11]))
        return tuple(c for row, p in zip(rows, (m[3], m[7], m[11]), strict=True) for c in (*row, p))

    placed = bound(placement(actor, target, upright), 12, shown_and_nearest)
    return bound(bound(bound(placed, 18, in_plane), 18, with_turn), 21, pose)
