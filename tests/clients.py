"""Stand-ins for model clients. Each call leaves a file, so that calls can be counted
across worker processes."""

from __future__ import annotations

import os
import time
import uuid


def recording(folder: str, answer):
    """``connect`` of a client that notes each call and gives ``answer(text, task)``."""
    def connect():
        def client(instructions, prompt, answer_schema, task, temperature):
            text = prompt.split("Post:\n", 1)[1]
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as out:
                out.write(f"{task}\t{temperature}\t{text}")
            return answer(text, task)
        return client
    return connect


def calls(folder: str) -> list[str]:
    return [open(os.path.join(folder, name)).read() for name in os.listdir(folder)]


def good(text, task):
    return {"sentiment_label": "positive", "sentiment_score": 0.5,
            "sentiment_emotions": ["joy"], "sentiment_topics": [text]}


def faulty(text, task):
    """Misbehaves as the text says."""
    if text == "raise":
        raise RuntimeError("no answer today")
    if text == "list":
        return ["positive"]
    if text == "number":
        return {**good(text, task), "sentiment_score": "0.9"}
    if text == "missing":
        return {"sentiment_label": "negative"}
    if text == "extra":
        return {**good(text, task), "mood": "sunny"}
    if text == "unknown":
        return {**good(text, task), "sentiment_label": "furious"}
    if text == "text":
        return '{"sentiment_label": "negative", "sentiment_score": 1, ' \
               '"sentiment_emotions": [], "sentiment_topics": []}'
    if text == "broken":
        return "not { json"
    if text == "slow":
        time.sleep(0.5)
    return good(text, task)


def hanging(text, task):
    if text == "hang":
        time.sleep(3600)
    return good(text, task)
