"""Vocabulary of the URL filter: strict terms, one of which rejects a url, and soft terms with weights.

A soft term of weight 3 speaks for itself nearly; one of weight 2 is an everyday word that only counts in company. A url
is rejected when its different soft terms weigh `SOFT_LIMIT` together, so no soft term rejects alone and any two do.
"""

from __future__ import annotations

SOFT_LIMIT = 4

_STRICT = {
    "gambling": "casino casinos gambling roulette blackjack baccarat sportsbook bookmaker jackpots slotmachine",
    "adult": "porn porno pornstar xxx adult milf hentai camgirl camgirls escorts nsfw fetish blowjob hardcore",
    "drugs": "pills viagra cialis levitra tramadol xanax oxycontin ambien phentermine steroids",
    "malware": "malware phishing ransomware keylogger trojan spyware botnet exploitkit cryptojacking",
    "piracy": "warez keygen serialz torrents crackz nulled cracked rapidgator",
    "fraud": "fakeid counterfeit carding moneymule pyramidscheme ponzi",
}
_SOFT_3 = {
    "gambling": "bets bet poker bingo slots lottery betting wager odds",
    "adult": "sex cam cams nude naked erotic dating hookup webcam",
    "advertising": "ads adserver adclick popunder banner banners affiliate affiliates clickbait",
    "spam": "spam linkfarm doorway seo backlinks",
    "money": "payday loans loan forex crypto bitcoin",
    "drugs": "pharmacy meds rx weightloss diet",
    "piracy": "crack serial torrent proxy unblocked",
}
_SOFT_2 = (
    "free win cheap track farm click bonus winner prize discount deals coupon promo offer offers download tracker tracking "
    "redirect pixel popup vip hot girls boys live chat replica outlet wholesale cash earn rich instant guaranteed miracle "
    "limited exclusive subscribe cure slim trial invest trading"
)

STRICT = sorted(w for words in _STRICT.values() for w in words.split())
SOFT = {w: 3 for words in _SOFT_3.values() for w in words.split()} | {w: 2 for w in _SOFT_2.split()}
