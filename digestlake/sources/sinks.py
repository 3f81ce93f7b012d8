"""Sinks: JSON and prompt files, manifests, payloads, and routing to destinations through a sender that the caller provides."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestlake.functions import text as T


def write_posts(posts: DataFrame, path: str) -> None:
    """JSON lines, one file for each partition."""
    posts.write.mode("overwrite").json(path)


def write_prompts(prompts: DataFrame, group: str, path: str) -> None:
    """A folder for each group that holds its prompt."""
    prompts.select(group, "prompt").write.mode("overwrite").partitionBy(group).option("lineSep", "\n").text(path)


def write_manifest(rows: DataFrame, stats: DataFrame, path: str) -> None:
    """One JSON object with stats and the groups, which are as many as topics or clusters."""
    listed = rows.agg(F.collect_list(F.struct(*rows.columns)).alias("clusters"))
    stats.agg(F.first(F.struct(*stats.columns)).alias("stats")).crossJoin(listed).coalesce(1).write.mode("overwrite").json(path)


#: The colour of an embed, and what each service takes at most.
COLOUR = 0x1DA1F2
MOST = {"slack": 3500, "discord": 1900, "webhook": 2000}
AUDIO_SUMMARY, AUDIO_BYTES = 300, 25 * 1024 * 1024
FOOTER = "Audio briefing attached below"


def slack_payload(content, title: str) -> Column:
    text = T.truncated(T.slack_links(content), MOST["slack"])
    quoted = F.to_json(F.struct(F.lit("mrkdwn").alias("type"), text.alias("text")))
    head = json.dumps({"type": "header", "text": {"type": "plain_text", "text": title, "emoji": True}})
    return F.concat(F.lit('{"blocks": [' + head + ', {"type": "section", "text": '), quoted, F.lit("}]}"))


def discord_payload(content, title: str) -> Column:
    """Cut first and then cleaned."""
    return F.to_json(F.struct(F.array(F.struct(F.lit(title[:256]).alias("title"), T.sanitized(T.truncated(content, MOST["discord"])).alias("description"), F.lit(COLOUR).alias("color"))).alias("embeds")))


def audio_payload(content, title: str) -> Column:
    """What goes with an audio file: the first characters of the text, and a footer. The file itself is the sender's."""
    text = F.coalesce(F.col(content) if isinstance(content, str) else content, F.lit(""))
    summary = F.when(F.length(text) > AUDIO_SUMMARY, F.concat(F.substring(text, 1, AUDIO_SUMMARY), F.lit("..."))).otherwise(text)
    embed = F.struct(F.lit(title[:256]).alias("title"), T.sanitized(summary).alias("description"), F.lit(COLOUR).alias("color"), F.struct(F.lit(FOOTER).alias("text")).alias("footer"))
    return F.to_json(F.struct(F.array(embed).alias("embeds")))


def webhook_payload(content, title: str) -> Column:
    return F.to_json(F.struct(F.lit(title).alias("title"), T.truncated(content, MOST["webhook"]).alias("content")))


def body(service: str, content: str, title: str) -> str:
    """The body for one document that is at hand, as the payload of the service has it."""
    most = MOST.get(service, MOST["webhook"])
    if service == "slack":
        content = re.sub(r"\[([^\]]+)\]\((https://[^)]+)\)", r"<\2|\1>", content)
    if len(content) > most:
        content = content[: most - 50] + "\n\n... (truncated)"
    if service == "slack":
        return json.dumps({"blocks": [{"type": "header", "text": {"type": "plain_text", "text": title, "emoji": True}}, {"type": "section", "text": {"type": "mrkdwn", "text": content}}]})
    if service == "discord":
        return json.dumps({"embeds": [{"title": title[:256], "description": re.sub("\n{3,}", "\n\n", content.replace("\x00", "")), "color": COLOUR}]})
    return json.dumps({"title": title, "content": content})


PAYLOADS = {"slack": slack_payload, "discord": discord_payload, "webhook": webhook_payload}
#: The setting that holds each destination's address, and the variable of the environment that may.
ADDRESS = {"slack": ("webhook_url", "SLACK_WEBHOOK_URL"), "discord": ("webhook_url", "DISCORD_WEBHOOK_URL"), "discord_bridge": ("url", "DISCORD_BRIDGE_URL"), "webhook": ("url", "WEBHOOK_URL"), "file": ("path", "DIGEST_FILE")}


def destinations(given: Mapping[str, str] | None = None, config: Mapping | None = None, env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Address by destination: given by hand, then of the configuration, then of the environment.

    A destination that the configuration disables has only what is given by hand. A bridge takes the place of its service.
    """
    env = os.environ if env is None else env
    out = {}
    for name, (key, variable) in ADDRESS.items():
        settings = ((config or {}).get("destinations") or {}).get(name) or {}
        off = settings.get("enabled") is False
        address = (given or {}).get(name) or ("" if off else settings.get(key) or env.get(variable, ""))
        if address:
            out[name] = address
    if "discord_bridge" in out:
        out.pop("discord", None)
    return out


def post(content: str, title: str, targets: Mapping[str, str], send: Callable[[str, str, str], bool]) -> bool:
    """Sends each target the body that its service takes; True if there are any and each took it. A file is written here, whole. A bridge takes what a webhook takes."""
    done = []
    for name, address in targets.items():
        if name == "file":
            os.makedirs(os.path.dirname(address) or ".", exist_ok=True)
            with open(address, "w", encoding="utf-8") as f:
                f.write(content)
            done.append(True)
        else:
            done.append(bool(send(name, address, body(name, content, title))))
    return bool(done) and all(done)
