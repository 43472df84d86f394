"""Model calls: a protocol that callers implement, and a deterministic stand-in that needs no network."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import Any, Protocol

from lectern.operators.topics import accepted, assignment_faults


class Provider(Protocol):
    def transcode(self, content: bytes, quality: int) -> bytes: ...
    def decode(self, audio: bytes) -> tuple[int, Any]: ...  # samples at 16 kHz, and what recognise() takes
    def speech(self, wave: Any) -> list[tuple[int, int]]: ...
    def recognise(self, wave: Any, clips: list[tuple[float, float]]) -> list[dict]: ...  # text and the three scores
    def complete(self, system: str, text: str, max_tokens: int) -> tuple[str, str]: ...  # status and text


def request_object(provider: Provider, system: str, payload: dict, max_tokens: int) -> dict:
    """A JSON object; anything else, or an answer that is not complete, raises."""
    status, text = provider.complete(system, json.dumps(payload, ensure_ascii=False), max_tokens)
    if status != "completed":
        raise RuntimeError(f"the answer is {status}")
    found = json.loads(text)
    if not isinstance(found, dict):
        raise RuntimeError("the answer is not an object")
    return found


def with_evidence(answer: dict, passages: dict[str, str]) -> dict:
    """The answer with the passage that each assignment's evidence_id names as its evidence; none where it names none."""
    given = answer.get("assignments")
    if not isinstance(given, list):
        return answer

    def passage(a: dict) -> str | None:
        ident = a.get("evidence_id")
        return passages.get(ident) if isinstance(ident, str) else None

    return answer | {"assignments": [a | {"evidence": passage(a)} if isinstance(a, dict) else a for a in given]}


def corrected(request: Callable[[dict], dict], judge: Callable[[dict], tuple[dict, list[str]]], attempts: int = 3) -> dict:
    """The first answer that ``judge`` finds no fault with; each faulty one goes back with its faults. What ``request`` itself raises is not retried."""
    faults, said = [], {}
    for _ in range(attempts):
        answer = request(said)
        found, faults = judge(answer)
        if not faults:
            return found
        said = {"previous_response": answer, "correction_request": "; ".join(faults)}
    return accepted(None, faults)


def classify(provider: Provider, system: str, payload: dict, topic_ids: set[str], summary: str, passages: dict[str, str], max_tokens: int, attempts: int = 3) -> dict:
    """The assignments of one class, by passages of its summary."""

    def judge(answer: dict) -> tuple[dict, list[str]]:
        found = with_evidence(answer, passages)
        return found, assignment_faults(found, topic_ids, summary)

    return corrected(lambda said: request_object(provider, system, payload | {"evidence_passages": passages} | said, max_tokens), judge, attempts)


class Deterministic:
    """Answers that follow from their input alone. ``fails``: whether a call with this text raises."""

    def __init__(self, fails: Callable[[str], bool] = lambda text: False) -> None:
        self.fails = fails

    def transcode(self, content: bytes, quality: int) -> bytes:
        return b"q%d:" % quality + content

    def decode(self, audio: bytes) -> tuple[int, bytes]:
        return len(audio) * 160, audio

    def speech(self, wave: bytes) -> list[tuple[int, int]]:
        return [(i * 160, i * 160 + 120) for i, b in enumerate(wave) if b % 2 == 0]

    def recognise(self, wave: bytes, clips: list[tuple[float, float]]) -> list[dict]:
        return [{"text": f" clip {a:.2f}-{b:.2f}.", "no_speech_prob": (k % 10) / 10, "avg_logprob": -0.5, "compression_ratio": 1.0} for k, (a, b) in enumerate(clips)]

    def complete(self, system: str, text: str, max_tokens: int) -> tuple[str, str]:
        if self.fails(text):
            raise RuntimeError("the model failed")
        try:
            asked = json.loads(text)
        except ValueError:
            asked = None
        if isinstance(asked, dict) and "class_summaries" in asked:
            return "completed", json.dumps({"topics": [{"id": f"topic_{i:02d}", "name": f"Тема {i}", "description": "Включать всё."} for i in (1, 2)]}, ensure_ascii=False)
        if isinstance(asked, dict) and "evidence_passages" in asked:
            first = next(iter(asked["evidence_passages"]), None)
            found = [{"topic_id": asked["topics"][0]["id"], "role": "primary", "evidence_id": first, "reason": "Развито."}] if first else []
            return "completed", json.dumps({"assignments": found, "unmatched_reason": "" if found else "Нет материала."}, ensure_ascii=False)
        mark = hashlib.sha256(text.encode()).hexdigest()[:8]
        return "completed", "\n\n".join(f"**{h}** {mark}." for h in ("Тема занятия", "Разобранные темы", "Глубина проработки", "Границы"))
