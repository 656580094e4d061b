"""Model endpoints: clients of three public protocols over HTTP, each a ``ModelClient``.

A client is built in the worker from an ``Endpoint``, which travels with the job; its token is given by the caller and
is shown nowhere. Retries, rate limits and dead letters are ``model.call``'s: a client makes one request and says, as
``ModelError``, with which status it failed.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from .model import ModelClient, ModelError

# The protocols' field names in which a reply's text and reasoning stand, and the size of a quoted error.
TEXT_FIELDS = ("text", "content", "reasoning_content", "reasoning", "output_text")
REASONING_FIELDS = ("reasoning_content", "reasoning", "reasoning_details")
MESSAGES_VERSION = "2023-06-01"
QUOTED = 1000


@dataclass(frozen=True)
class Endpoint:
    url: str
    model: str = ""
    token: str = field(default="", repr=False)
    timeout: float = 300.0
    #: Values that every request has unless its settings say otherwise.
    settings: tuple[tuple[str, object], ...] = ()


def reply_text(value: object) -> str:
    """All text of a nested reply: lists in order, of an object its first field that holds any."""
    if isinstance(value, list):
        return "".join(map(reply_text, value))
    if isinstance(value, dict):
        return next(filter(None, (reply_text(value.get(name)) for name in TEXT_FIELDS)), "")
    return "" if value is None else str(value)


def inline_image(image: str) -> tuple[str, str]:
    """(media type, base64 text) of a data URL."""
    kind, _, data = image.removeprefix("data:").partition(";base64,")
    if not data:
        raise ModelError("the image is no data URL")
    return kind, data


def with_reasoning(reasoning: str, content: str) -> str:
    """A reply in one text, its reasoning as a block before it."""
    return f"<think>\n{reasoning.strip()}\n</think>\n\n{content.strip()}".strip() if reasoning.strip() else content.strip()


class HttpClient:
    """One JSON request a call."""

    def __init__(self, endpoint: Endpoint) -> None:
        self.endpoint = endpoint

    def headers(self) -> dict[str, str]:
        return {"Authorization": f"Bearer {self.endpoint.token}"} if self.endpoint.token else {}

    def body(self, prompt: str, image: str | None, settings: dict) -> dict:
        raise NotImplementedError

    def read(self, lines: Iterator[bytes], settings: dict) -> str:
        """The reply's text from the response, which is read whole unless the protocol streams."""
        reply = json.loads(b"".join(lines))
        try:
            return self.text(reply)
        except (KeyError, IndexError, TypeError) as error:
            raise ModelError(f"unexpected reply: {json.dumps(reply)[:QUOTED]}") from error

    def text(self, reply: dict) -> str:
        raise NotImplementedError

    def complete(self, prompt: str, image: str | None, settings: dict) -> str:
        own = dict(self.endpoint.settings) | settings
        data = json.dumps(self.body(prompt, image, own)).encode()
        request = urllib.request.Request(self.endpoint.url, data, {"Content-Type": "application/json", **self.headers()}, method="POST")
        try:
            with urllib.request.urlopen(request, timeout=self.endpoint.timeout) as response:
                return self.read(iter(response), own)
        except urllib.error.HTTPError as error:
            raise ModelError(f"HTTP {error.code}: {error.read().decode(errors='replace')[:QUOTED]}", error.code) from None


class GenerateContentClient(HttpClient):
    """The generateContent protocol: a list of parts in, candidates out."""

    def headers(self) -> dict[str, str]:
        return {"x-goog-api-key": self.endpoint.token} if self.endpoint.token else {}

    def body(self, prompt: str, image: str | None, settings: dict) -> dict:
        parts: list[dict] = []
        if image:
            kind, data = inline_image(image)
            parts.append({"inlineData": {"mimeType": kind, "data": data}})
        limits = {"maxOutputTokens": settings.get("max_tokens"), "temperature": settings.get("temperature"), "topP": settings.get("top_p")}
        return {
            "contents": [{"role": "user", "parts": [*parts, {"text": prompt}]}],
            "generationConfig": {k: v for k, v in limits.items() if v is not None},
            **settings.get("extra", {}),
        }

    def text(self, reply: dict) -> str:
        return "".join(part.get("text", "") for part in reply["candidates"][0]["content"]["parts"]).strip()


class ChatCompletionsClient(HttpClient):
    """The chat-completions protocol, whole or as server-sent events (``stream``, the default)."""

    def body(self, prompt: str, image: str | None, settings: dict) -> dict:
        content: str | list = prompt
        if image:
            content = [{"type": "image_url", "image_url": {"url": image}}, {"type": "text", "text": prompt}]
        limits = {k: settings[k] for k in ("max_tokens", "temperature", "top_p", "top_k") if k in settings}
        return {"model": self.endpoint.model, "messages": [{"role": "user", "content": content}], **limits, **settings.get("extra", {}), "stream": bool(settings.get("stream", True))}

    @staticmethod
    def pieces(choice: dict, message: dict) -> tuple[str, str]:
        """(reasoning, content) of a choice and its message or delta."""
        thought = (reply_text(holder.get(name)) for name in REASONING_FIELDS for holder in (message, choice))
        return next(filter(None, thought), ""), reply_text(message.get("content")) or reply_text(choice.get("text"))

    def text(self, reply: dict) -> str:
        choice = reply["choices"][0]
        return with_reasoning(*self.pieces(choice, choice.get("message") or {}))

    def read(self, lines: Iterator[bytes], settings: dict) -> str:
        if not settings.get("stream", True):
            return super().read(lines, settings)
        reasoning, content = [], []
        for event in events(lines):
            for choice in event.get("choices") or []:
                thought, said = self.pieces(choice, choice.get("delta") or {})
                reasoning.append(thought)
                content.append(said)
        return with_reasoning("".join(reasoning), "".join(content))


class MessagesClient(HttpClient):
    """The messages protocol: content blocks in and out."""

    def headers(self) -> dict[str, str]:
        return {**super().headers(), "anthropic-version": MESSAGES_VERSION}

    def body(self, prompt: str, image: str | None, settings: dict) -> dict:
        content: list[dict] = []
        if image:
            kind, data = inline_image(image)
            content.append({"type": "image", "source": {"type": "base64", "media_type": kind, "data": data}})
        content.append({"type": "text", "text": prompt})
        return {"model": self.endpoint.model, "max_tokens": settings.get("max_tokens", 8192), "messages": [{"role": "user", "content": content}], **settings.get("extra", {})}

    def text(self, reply: dict) -> str:
        return "".join(block.get("text", "") for block in reply.get("content") or [] if isinstance(block, dict)).strip()


def events(lines: Iterator[bytes]) -> Iterator[dict]:
    """The objects of a server-sent event stream up to its end mark; lines that hold none are passed over."""
    for line in lines:
        name, _, data = line.decode(errors="replace").strip().partition(":")
        if name != "data":
            continue
        if data.strip() == "[DONE]":
            return
        try:
            event = json.loads(data)
        except json.JSONDecodeError:
            continue
        if isinstance(event, dict):
            yield event


PROTOCOLS: dict[str, type[HttpClient]] = {"generate": GenerateContentClient, "chat": ChatCompletionsClient, "messages": MessagesClient}


def provider(protocol: str, endpoint: Endpoint) -> Callable[[], ModelClient]:
    """A factory, as the model stages take it, of a protocol's client for an endpoint."""
    kind = PROTOCOLS[protocol]
    return lambda: kind(endpoint)
