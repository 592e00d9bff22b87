"""Registry of source tables: how each maps to the common post schema."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass


@dataclass(frozen=True)
class Provider:
    """One source table. ``text`` is a SQL expression, the rest are column names."""

    table: str
    id: str
    text: str
    author: str | None = None
    likes: str | None = None
    shares: str | None = None
    comments: str | None = None
    views: str | None = None
    posted_at: str | None = None
    keyword: str | None = None
    region: str | None = None
    url: str | None = None
    scraped_at: str = "scraped_at"


# Column names of the seven crawler tables.
_KNOWN = (
    Provider("x_tweets", id="tweet_id", text="tweet_text", author="author",
             likes="likes", shares="retweets", comments="replies", views="views",
             posted_at="posted_at", keyword="keyword", region="region"),
    Provider("apify_x_tweets", id="id", text="text", author="author_username",
             likes="like_count", shares="retweet_count", comments="reply_count",
             views="view_count", posted_at="created_at", keyword="keyword",
             region="region"),
    Provider("apify_tiktok_posts", id="id", text="text", author="author_username",
             likes="digg_count", shares="share_count", comments="comment_count",
             views="play_count", posted_at="created_at", keyword="keyword",
             region="region"),
    Provider("instagram_posts", id="post_id", text="caption", author="username",
             likes="likes", comments="comments", views="views", keyword="keyword",
             region="region"),
    Provider("reddit_posts", id="post_id",
             text="coalesce(title || ' ' || caption, title, caption)", author="author",
             likes="upvotes", comments="comments", posted_at="posted_at",
             keyword="keyword"),
    Provider("tiktok_videos", id="video_id", text="description", author="creator",
             likes="likes", shares="shares", comments="comments", views="views",
             keyword="keyword"),
    Provider("youtube_videos", id="video_id", text="title", author="channel",
             likes="likes", comments="comments", views="views", posted_at="upload_date",
             keyword="keyword", region="region"),
)

_registry: dict[str, Provider] = {provider.table: provider for provider in _KNOWN}


def register_provider(provider: Provider, name: str | None = None) -> Provider:
    """Add a source, or replace the one of the same name."""
    _registry[name or provider.table] = provider
    return provider


def registered() -> dict[str, Provider]:
    return dict(_registry)


def choose(names: str | Iterable[str] | None = None,
           registry: dict[str, Provider] | None = None,
           ) -> tuple[dict[str, Provider], list[str]]:
    """Providers by name, in registry order, and the names that are unknown.

    ``names`` is a list or a comma-separated text; nothing, or only blanks,
    selects all.
    """
    registry = registered() if registry is None else registry
    if names is None:
        return dict(registry), []
    parts = names.split(",") if isinstance(names, str) else names
    wanted = {part.strip() for part in parts} - {""}
    if not wanted:
        # An explicit text such as "," names nobody; an empty one names all.
        blank = not isinstance(names, str) or not names.strip()
        return (dict(registry), []) if blank else ({}, [])
    chosen = {name: p for name, p in registry.items() if name in wanted}
    return chosen, sorted(wanted - registry.keys())
