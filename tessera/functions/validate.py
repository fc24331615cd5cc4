"""Checks of annotation payloads, with lax coercion: unknown keys are dropped, numbers may come as text, text may not
come as numbers."""

from __future__ import annotations

from collections.abc import Callable

# Fixed values of the annotation formats.
QUALITY = ("High", "Medium", "Low/Blurry")
SUBJECT = ("Person/People", "Animal(s)", "Vehicle(s)", "Food", "Object(s)", "Scenery/Architecture", "Other")
PRESENCE = ("None", "Single Person", "Small Group (2-5)", "Crowd (>5)")
FACES = ("Clear Faces", "Obscured/No Faces", "Not Applicable")
TEXT_TYPE = ("Printed", "Handwritten", "Signage/Logo", "Not Applicable")
TRUE, FALSE = ("1", "true", "t", "yes", "y", "on"), ("0", "false", "f", "no", "n", "off")

Check = Callable[[object, str], object]


class Invalid(ValueError):
    """What is wrong, led by the path to it."""


def text(v, at):
    if not isinstance(v, str):
        raise Invalid(f"{at}: not a string")
    if not v:
        raise Invalid(f"{at}: empty")
    return v


def optional_text(v, at):
    if v is not None and not isinstance(v, str):
        raise Invalid(f"{at}: not a string")
    return v


def count(v, at):
    try:
        n = int(v) if isinstance(v, (str, bool, int)) else int(v) if isinstance(v, float) and v == int(v) else None
    except (ValueError, OverflowError):
        n = None
    if n is None or isinstance(v, str) and "_" in v.strip("_") and not v.replace("_", "").isdigit():
        raise Invalid(f"{at}: not an integer")
    if n < 0:
        raise Invalid(f"{at}: negative")
    return n


def flag(v, at):
    if isinstance(v, bool):
        return v
    word = v.lower() if isinstance(v, str) else str(int(v)) if isinstance(v, (int, float)) and v in (0, 1) else None
    if word in TRUE or word in FALSE:
        return word in TRUE
    raise Invalid(f"{at}: not a truth value")


def one_of(*values: str) -> Check:
    def check(v, at):
        if v not in values or not isinstance(v, str):
            raise Invalid(f"{at}: not one of the allowed values")
        return v

    return check


def listed(item: Check, least: int, most: int | None = None) -> Check:
    def check(v, at):
        if not isinstance(v, list):
            raise Invalid(f"{at}: not a list")
        if len(v) < least or most is not None and len(v) > most:
            raise Invalid(f"{at}: {len(v)} items")
        return [item(x, f"{at}.{i}") for i, x in enumerate(v)]

    return check


def fields(optional: tuple[str, ...] = (), **checks: Check) -> Check:
    def check(v, at):
        if not isinstance(v, dict):
            raise Invalid(f"{at or 'payload'}: not an object")
        out = {}
        for name, c in checks.items():
            path = f"{at}.{name}" if at else name
            if name not in v:
                if name not in optional:
                    raise Invalid(f"{path}: missing")
                out[name] = None
            else:
                out[name] = c(v[name], path)
        return out

    return check


TEXT_ANNOTATION = fields(
    knowledge_qa=listed(fields(question=text, answer=text), 3, 7),
    detailed_explanation=fields(instruction=text, response=text),
    analytical_reasoning=fields(instruction=text, response=text),
    conversational_exchange=fields(opening_question=text, opening_response=text, follow_up_question=text, follow_up_response=text),
    metadata=fields(language=text, topics=listed(lambda v, at: _plain(v, at), 1), domain=text),
)

IMAGE_ANNOTATION = fields(
    info=fields(
        content_properties=fields(quality=one_of(*QUALITY), primary_subject=one_of(*SUBJECT), object_count=count, human_presence=one_of(*PRESENCE), face_visibility=one_of(*FACES)),
        text_properties=fields(contains_text=flag, is_suitable_for_ocr=flag, text_type=one_of(*TEXT_TYPE)),
        task_suitability=fields(is_suitable_for_counting=flag, is_suitable_for_reasoning=flag, is_suitable_for_multi_step_instruction=flag),
    ),
    caption=fields(text=text),
    vqa=listed(fields(question=text, answer=text), 3, 7),
    ocr=fields(("instruction", "answer"), instruction=optional_text, answer=optional_text),
    reason=fields(instruction=text, answer=text),
    instruct_follow=fields(instruction=text, answer=text),
)


def _plain(v, at):
    if not isinstance(v, str):
        raise Invalid(f"{at}: not a string")
    return v


def validated(check: Check, payload) -> dict:
    return check(payload, "")
