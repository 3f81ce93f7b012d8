"""Pattern catalogues, and their translation to the two regex dialects in use.

Patterns are written once, in Python's notation. Word characters and boundaries are Unicode there, so java() and re2()
spell them out: java() with look-around for Spark, re2() by consuming a neighbour for engines without look-around.
"""

from __future__ import annotations

import re

# Topics in the order in which they are tried and listed.
TOPICS = {
    "ai": [r"\bai\b", r"\bgpt", r"\bclaude\b", r"\bllm", r"\bopenai\b", r"\banthropic\b", r"\bgemini\b", r"\bcopilot\b", r"\bchatgpt\b", r"\bmodel\b", r"\bagent", r"\bmachine learning\b", r"\bdeep learning\b", r"\bneural\b"],
    "crypto": [r"\bbtc\b", r"\beth\b", r"\bbitcoin\b", r"\bethereum\b", r"\bcrypto\b", r"\bsolana\b", r"\bnft\b", r"\bdefi\b", r"\bweb3\b", r"\btoken\b", r"\bwallet\b", r"\bblockchain\b"],
    "politics": [r"\btrump\b", r"\bbiden\b", r"\bcongress\b", r"\bsenate\b", r"\bhouse\b", r"\bdemocrat", r"\brepublican", r"\bgop\b", r"\belection\b", r"\bvote\b", r"\bpolicy\b", r"\bgovernment\b", r"\bpolitics\b", r"\bpresident\b"],
    "tech": [r"\bstartup\b", r"\bvc\b", r"\bfunding\b", r"\bipo\b", r"\bacquisition\b", r"\bsaas\b", r"\bapi\b", r"\bcloud\b", r"\baws\b", r"\bgoogle\b", r"\bmicrosoft\b", r"\bmeta\b", r"\bapple\b", r"\btesla\b"],
    "finance": [r"\bstock\b", r"\bmarket\b", r"\btreasury\b", r"\byield\b", r"\bfed\b", r"\binflation\b", r"\brecession\b", r"\bearnings\b", r"\bipo\b", r"\bs&p\b", r"\bnasdaq\b", r"\bdow\b"],
    "culture": [r"\bmeme\b", r"\bviral\b", r"\btrending\b", r"\bmovie\b", r"\bmusic\b", r"\bgame\b", r"\bsports\b", r"\bnfl\b", r"\bnba\b", r"\bmlb\b"],
    "science": [r"\bspace\b", r"\bnasa\b", r"\bclimate\b", r"\bresearch\b", r"\bstudy\b", r"\bscientist\b", r"\bdiscovery\b", r"\bmoon\b", r"\bmars\b"],
    "geopolitics": [r"\bukraine\b", r"\brussia\b", r"\bchina\b", r"\bisrael\b", r"\bgaza\b", r"\bpalestine\b", r"\bnato\b", r"\beu\b", r"\bwar\b", r"\bmilitary\b", r"\bgreenland\b", r"\bcanada\b", r"\bdavos\b"],
}
# Accounts that stand for a topic.
ACCOUNT_TOPICS = {
    "sama": "ai", "daboromell": "ai", "klogg": "ai", "emollick": "ai", "ylecun": "ai", "ilyasut": "ai", "janleike": "ai", "aaborowell": "ai",
    "vitalikbuterin": "crypto", "saylor": "crypto", "caborinbase": "crypto", "brian_armstrong": "crypto", "cz_binance": "crypto",
    "potus": "politics", "whitehouse": "politics", "speaker": "politics",
    "elonmusk": "tech", "sataboranadella": "tech", "timcook": "tech",
    "unusual_whales": "finance", "zerohedge": "finance",
}
# Companies and products.
COMPANIES = ["OpenAI", "Anthropic", "Google", "Microsoft", "Meta", "Apple", "Tesla", "Amazon", "Netflix", "Nvidia", "AMD", "Intel", "Coinbase", "Stripe", "Vercel", "Figma", "Notion", "Slack", "Discord", "Twitter", "X"]
PRODUCTS = ["GPT-4", "GPT-5", "Claude", "Gemini", "Copilot", "ChatGPT", "iPhone", "Vision Pro", "Model S", "Cybertruck"]
# Signals of promotion.
CALLS_TO_ACTION = [
    r"\bsign up\b", r"\bsignup\b", r"\bregister now\b", r"\buse code\b", r"\bdiscount code\b", r"\bpromo code\b", r"\bshop now\b", r"\bbuy now\b", r"\border now\b", r"\bget yours\b",
    r"\blink in bio\b", r"\bcheck link\b", r"\bclick (?:the )?link\b", r"\blimited time\b", r"\bflash sale\b", r"\b\d+% off\b", r"\bfree trial\b", r"\bfree shipping\b",
    r"\bsubscribe (?:now|today|here)\b", r"\bjoin (?:us|now|today|our)\b", r"\bdon'?t miss (?:out|this)\b", r"\bgrab (?:yours|it|this)\b", r"\bclaim (?:your|now)\b", r"\bunlock\b.*\bfree\b",
    r"\bgiveaway\b", r"\b(?:enter to )?win\b.*\b(?:prize|giveaway)\b", r"\bretweet (?:to|and|&) (?:win|enter)\b", r"\bfollow (?:us|me) (?:and|&|to)\b", r"\bwe(?:'re| are) (?:hiring|looking for)\b",
    r"\bapply (?:now|today|here)\b", r"\blearn more at\b", r"\bvisit (?:us at|our)\b",
]
THREAD_BAIT = [r"^(?:1[/.)]\s|🧵)", r"\ba thread\b.*🧵", r"\bhere(?:'s| is) (?:a |my |the )?thread\b", r"\blet me (?:explain|break|walk)\b", r"\b(?:mega|master) ?thread\b"]
AFFILIATE_LINKS = [r"(?:ref|affiliate|partner|utm_source|utm_campaign)=", r"\b(?:amzn\.to|bit\.ly|tinyurl|shorte\.st|linktr\.ee)\b"]
PROMO_ACCOUNTS = [r"deals$", r"offers$", r"promo", r"official$", r"^get", r"shop", r"^try"]
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FA6F}\x{1FA70}-\x{1FAFF}]+"
# Signals of news.
NEWS = [
    r"\bbreaking\b", r"\bjust (?:announced|confirmed|released|reported|happened)\b", r"\bexclusive\b", r"\bconfirmed\b", r"\bnew(?:ly)? (?:announced|released|launched|discovered|revealed|published)\b",
    r"\bofficially?\b", r"\breport(?:s|ed|ing)?\b", r"\baccording to\b", r"\bsources? say\b", r"\b(?:per|via) @\w+\b", r"\b(?:announced|reveals?|unveils?|launches?|releases?)\b",
    r"\bupdate(?:d|s)?\b.*\b(?:on|to|about)\b", r"\b(?:study|research) (?:shows?|finds?|reveals?|confirms?)\b",
]
FACTS = [r"\b(?:said|stated|announced|confirmed|denied)\b", r"\b(?:according|reportedly|sources)\b", r"\b(?:data|numbers?|statistics?|figures?|percent|%)\b", r"\b(?:million|billion|trillion)\b", r"\b(?:CEO|CTO|CFO|president|prime minister|spokesperson)\b"]
# Words that name no news, and capitalised words that name nothing.
NOT_NEWS = ["the", "this", "that", "what", "when", "where", "why", "how", "just", "now", "new", "today", "here", "not", "but", "and", "for", "all", "its", "has", "was", "are", "been", "have", "will", "can"]
NOT_ENTITIES = ["The", "This", "That", "What", "When", "Where", "Why", "How", "I", "We", "They", "You", "It", "A", "An", "And", "Or", "But", "Just", "Now", "New", "Today", "Here", "So", "If", "My", "Your"]
# What an entity is called by.
SYNONYMS = {
    "btc": "Bitcoin", "bitcoin": "Bitcoin", "$btc": "Bitcoin", "ビットコイン": "Bitcoin",
    "eth": "Ethereum", "ethereum": "Ethereum", "$eth": "Ethereum", "イーサリアム": "Ethereum",
    "sol": "Solana", "solana": "Solana", "$sol": "Solana", "ソラナ": "Solana",
    "xrp": "XRP", "$xrp": "XRP", "ripple": "XRP", "リップル": "XRP",
    "doge": "Dogecoin", "dogecoin": "Dogecoin", "$doge": "Dogecoin",
    "defi": "DeFi", "ディーファイ": "DeFi", "nft": "NFT", "web3": "Web3",
    "stablecoin": "Stablecoin", "usdc": "Stablecoin", "usdt": "Stablecoin", "ステーブルコイン": "Stablecoin",
    "etf": "ETF", "sec": "SEC", "coinbase": "Coinbase", "binance": "Binance", "microstrategy": "MicroStrategy", "saylor": "MicroStrategy", "blackrock": "BlackRock",
}
BROAD = ["Bitcoin", "Ethereum", "Solana", "XRP", "Dogecoin", "DeFi", "NFT", "Web3", "Stablecoin"]
NOT_PROPER = [
    "The", "This", "That", "With", "From", "Have", "Will", "Just", "Your", "About", "What", "When", "Where", "Here", "There", "They", "Their", "Them", "Then",
    "And", "But", "For", "Not", "You", "All", "Are", "Was", "Has", "Now", "New", "Why", "How", "Who", "Out", "Get", "One", "Two", "Today", "Via", "RT",
]
#: Words left out of labels and vectors unless others are given.
STOP_WORDS = [
    "the", "and", "for", "that", "with", "this", "from", "are", "was", "were", "have", "has", "had", "not", "but", "you", "they", "she", "his", "her", "its", "our", "their", "who", "what", "when", "where",
    "how", "all", "any", "can", "will", "would", "could", "should", "been", "being", "into", "than", "then", "there", "here", "these", "those", "which", "while", "just", "about", "also", "more", "most",
    "some", "such", "only", "own", "same", "very", "one", "new", "now", "get", "got", "say", "says", "said", "out", "over", "off", "down",
]
#: Left out of cluster keywords besides.
MARKUP_WORDS = ["user", "users", "https", "http", "co", "amp", "rt", "via"]

WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
ON_LINE = r"[^\p{L}\p{N}_\n]"
BLANK = r"[\s\p{Z}]"


def _plain(pattern: str) -> str:
    return pattern.replace(r"\w", WORD).replace(r"\d", r"\p{Nd}")


def java(pattern: str) -> str:
    """The pattern with its boundaries as look-around."""
    parts = _plain(pattern).split(r"\b")
    if "%)" in pattern:
        return rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))".join(parts)
    out = parts[0]
    for before, after in zip(parts, parts[1:]):
        leads = before == "" or before.endswith(".*")
        out += (rf"(?<!{WORD})" if leads else rf"(?!{WORD})") + after
    return out


def re2(pattern: str) -> str:
    """The pattern with its boundaries as neighbours, for tests of whether it occurs."""
    p = _plain(pattern)
    if "|%)" in p:
        return re2(p.replace("|%)", ")")) + f"|{WORD}%{WORD}"
    p = p.replace(r"\b.*\b", f"(?:{ON_LINE}|{ON_LINE}.*{ON_LINE})").replace(r"\b.*", f"(?:{ON_LINE}.*)?")
    if p.startswith(r"\b"):
        p = f"(?:^|{NOT_WORD})" + p[2:]
    if p.endswith(r"\b"):
        p = p[:-2] + f"(?:$|{NOT_WORD})"
    return p


def any_java(patterns: list[str]) -> str:
    """One alternation; a boundary that leads all of it is tested once at each place."""
    forms, lead = list(map(java, patterns)), f"(?<!{WORD})"
    if all(f.startswith(lead) for f in forms):
        return f"(?iud){lead}(?:" + "|".join(f[len(lead) :] for f in forms) + ")"
    return "(?iud)(?:" + "|".join(forms) + ")"


def any_re2(patterns: list[str]) -> str:
    return "(?i)(?:" + "|".join(map(re2, patterns)) + ")"


_ATOM = re.compile(r"\\b|\\.|\[[^\]]*\]|\(\?:|.", re.S)
_GAP, _EDGE = object(), object()


def _forms(atoms: list[str]) -> list[tuple]:
    """What an alternation can look like: sequences of characters, edges (boundaries) and gaps (all else). It is taken off the front of atoms, with the bracket that closes it."""
    every, now = [], [()]
    while atoms:
        atom = atoms.pop(0)
        if atom == ")":
            break
        if atom == "|":
            every, now = every + now, [()]
            continue
        if atom in ("(?:", "("):
            part = _forms(atoms)
        elif atom == r"\b":
            part = [(_EDGE,)]
        elif atom in "^$." or atom[0] == "[" or (atom[0] == "\\" and atom[1].isalnum()):
            part = [(_GAP,)]
        else:
            part = [(atom[-1],)]
        if atoms and atoms[0] in "?*+":
            part = part + [()] if atoms.pop(0) == "?" else [(_GAP,)]
        now = [a + b for a in now for b in part]
    return every + now


def _word(c) -> bool:
    return isinstance(c, str) and (c.isalnum() or c == "_")


def needs(pattern: str) -> list[tuple[list[str], list[str], bool]] | None:
    """The ways in which the pattern can match: whole words and parts of words, in lower case, that a text then has, and whether one word is all it takes.

    None if a text may match without any. Words begin and end at boundaries, so a word of a form is whole where an edge or another character is on both sides.
    """
    out = []
    for form in _forms(_ATOM.findall(pattern.lower())):
        words, parts, at = [], [], 0
        while at < len(form):
            end = at
            while end < len(form) and _word(form[end]):
                end += 1
            if end > at:
                sides = [form[i] if 0 <= i < len(form) else _GAP for i in (at - 1, end)]
                (parts if _GAP in sides else words).append("".join(form[at:end]))
            at = max(end, at + 1)
        if not words and not parts:
            return None
        out.append((words, parts, len(words) == 1 and form == (_EDGE, *words[0], _EDGE)))
    return out


def exactly(name: str) -> str:
    """A pattern for a literal name between boundaries."""
    return rf"\b{name}\b"
