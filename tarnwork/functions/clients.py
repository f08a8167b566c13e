"""HTTP clients of model services that speak the common chat and embeddings protocol; standard library only.

Factories for models.summarize and models.embed: functools.partial(ChatSummarizer, base_url=..., key=..., model=...).
"""

from __future__ import annotations

import base64
import json
import urllib.error
import urllib.request
from dataclasses import dataclass

from .models import resized

PROMPT = "Describe this picture from a technical document in two to four short sentences, for someone who searches for it: objects, text, charts, tables, diagrams. Say only what can be seen."


class APIError(Exception):
    """The service answered with an error, or with something else than was asked for."""


class APITimeoutError(APIError):
    """The service took too long."""


@dataclass
class _Client:
    base_url: str
    key: str = ""
    model: str = ""
    timeout: float = 60.0

    def post(self, path: str, body: dict) -> dict:
        request = urllib.request.Request(f"{self.base_url.rstrip('/')}/{path}", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return json.load(answer)
        except urllib.error.HTTPError as e:
            raise APIError(f"{e.code} from {path}") from e
        except TimeoutError as e:
            raise APITimeoutError(path) from e
        except urllib.error.URLError as e:
            if isinstance(e.reason, TimeoutError):
                raise APITimeoutError(path) from e
            raise ConnectionError(str(e.reason)) from e
        except ValueError as e:
            raise APIError(f"no JSON from {path}") from e


@dataclass
class ChatSummarizer(_Client):
    """A sentence or two about an image."""

    timeout: float = 120.0
    longest: int = 1024
    max_tokens: int = 300
    temperature: float = 0.2

    def __call__(self, image: bytes) -> str:
        try:
            image = resized(image, self.longest)
        except NotImplementedError:  # without an imaging library the image goes as it is
            pass
        url = f"data:image/png;base64,{base64.b64encode(image).decode()}"
        content = [{"type": "text", "text": PROMPT}, {"type": "image_url", "image_url": {"url": url}}]
        answer = self.post("chat/completions", {"model": self.model, "messages": [{"role": "user", "content": content}], "max_tokens": self.max_tokens, "temperature": self.temperature})
        try:
            return (answer["choices"][0]["message"]["content"] or "").strip()
        except (KeyError, IndexError, TypeError) as e:
            raise APIError("an answer without a message") from e


@dataclass
class PassageEmbedder(_Client):
    """Vectors of passages, in the order of the texts; too long ones are cut at their end by the service."""

    def __call__(self, texts: list[str]) -> list[list[float]]:
        answer = self.post("embeddings", {"model": self.model, "input": texts, "encoding_format": "float", "input_type": "passage", "truncate": "END"})
        try:
            return [d["embedding"] for d in sorted(answer["data"], key=lambda d: d.get("index", 0))]
        except (KeyError, TypeError) as e:
            raise APIError("an answer without vectors") from e
