"""A seeded synthetic league: season CSVs and game documents as they arrive."""

from __future__ import annotations

import json
import random
from datetime import date, datetime, timedelta
from pathlib import Path

from touchline.params import GAME_NAMES, MATCH_NAMES

POSITIONS = [(1, "Goalkeeper", "GKP", 2), (2, "Defender", "DEF", 5), (3, "Midfielder", "MID", 5), (4, "Forward", "FWD", 3)]
CODES = ["FTHG", "FTAG", "FTR", "HTHG", "HTAG", "HTR", "Referee", "HS", "AS", "HST", "AST", "HF", "AF", "HC", "AC",
         "HY", "AY", "HR", "AR"]


def spellings(table):
    out = {}
    for name, canonical in table.items():
        out.setdefault(canonical, name)
    return out


MATCH_SPELLING, GAME_SPELLING = spellings(MATCH_NAMES), spellings(GAME_NAMES)
CLUBS = sorted(set(MATCH_SPELLING) & set(GAME_SPELLING))[:20]


def rounds(clubs):
    """Double round robin: 38 rounds of ten matches."""
    ring, out = list(clubs), []
    for r in range(len(ring) - 1):
        pairs = [(ring[i], ring[-1 - i]) for i in range(len(ring) // 2)]
        out.append([(b, a) if (r + i) % 2 else (a, b) for i, (a, b) in enumerate(pairs)])
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out + [[(b, a) for a, b in games] for games in out]


class World:
    live_rounds = 6

    def __init__(self, root: Path):
        self.random = random.Random(7)
        self.root, self.matches_dir, self.game_dir = root, root / "matches", root / "game"
        self.matches_dir.mkdir()
        self.game_dir.mkdir()
        self.schedule = rounds(CLUBS)
        self.matches = []
        self._season("2526", date(2025, 8, 16), 38)
        self._season("2627", date(2026, 8, 15), self.live_rounds)
        self._documents()

    def _match(self, season, day, home, away):
        r = self.random
        hg, ag = r.randint(0, 4), r.randint(0, 3)
        ht = (r.randint(0, hg), r.randint(0, ag))
        sign = lambda a, b: "H" if a > b else "A" if a < b else "D"
        row = {"season": season, "day": day, "home": home, "away": away, "FTHG": hg, "FTAG": ag, "FTR": sign(hg, ag),
               "HTHG": ht[0], "HTAG": ht[1], "HTR": sign(*ht),
               "Referee": "" if r.random() < 0.1 else r.choice(["M Oliver", "A Taylor", "J Müller"])}
        row.update({c: r.randint(0, 15) for c in CODES[7:]})
        return row

    def _season(self, season, start, count):
        rows = [self._match(season, start + timedelta(days=7 * n), h, a)
                for n, games in enumerate(self.schedule[:count]) for h, a in games]
        self.matches += rows
        late = season == "2627"
        columns = (["Div", "AwayTeam", "HomeTeam", "Time", "Date", *reversed(CODES), "B365H"] if late
                   else ["Div", "Date", "HomeTeam", "AwayTeam", *CODES])
        lines = [",".join(columns)]
        for r in rows:
            value = {"Div": "E0", "Time": "15:00", "B365H": "1.5",
                     "Date": r["day"].strftime("%d/%m/%Y" if late else "%d/%m/%y"),
                     "HomeTeam": MATCH_SPELLING[r["home"]], "AwayTeam": MATCH_SPELLING[r["away"]], **r}
            lines.append(",".join(str(value[c]) for c in columns))
        if late:
            # One more fixture, not yet played, and one repeated line.
            h, a = self.schedule[count][0]
            value = {c: "" for c in columns} | {"Div": "E0", "Date": "01/12/2026", "HomeTeam": MATCH_SPELLING[h],
                                                "AwayTeam": MATCH_SPELLING[a]}
            lines += [",".join(value[c] for c in columns), lines[1]]
        # The old file is Latin-1, the live one carries a byte-order mark.
        data = "\n".join(lines) + "\n"
        path = self.matches_dir / f"E0_{season}.csv"
        path.write_bytes(data.encode("utf-8-sig" if late else "latin-1"))

    def _documents(self):
        r, ids = self.random, {c: i + 1 for i, c in enumerate(CLUBS)}
        self.fixtures, number = [], 0
        for gw, games in enumerate(self.schedule, 1):
            for i, (h, a) in enumerate(games):
                number += 1
                played = gw <= self.live_rounds
                # The first match of round six was played a week early: a double and a blank.
                event = self.live_rounds - 1 if (gw, i) == (self.live_rounds, 0) else gw
                kickoff = datetime(2026, 8, 15, 15) + timedelta(days=7 * (gw - 1))
                self.fixtures.append({
                    "id": number, "event": None if (gw, i) == (38, 9) else event, "team_h": ids[h], "team_a": ids[a],
                    "team_h_difficulty": r.randint(1, 5), "team_a_difficulty": r.randint(1, 5), "finished": played,
                    "kickoff_time": kickoff.strftime("%Y-%m-%dT%H:%M:%SZ")})
        events = [{"id": gw, "name": f"Gameweek {gw}", "finished": gw <= self.live_rounds,
                   "deadline_time": (datetime(2026, 8, 14, 23, 30) + timedelta(days=7 * (gw - 1))).strftime("%Y-%m-%dT%H:%M:%SZ"),
                   "data_checked": gw < self.live_rounds, "is_current": gw == self.live_rounds,
                   "is_next": gw == self.live_rounds + 1, "average_entry_score": 50 if gw <= self.live_rounds else 0,
                   "highest_score": 120 if gw <= self.live_rounds else None} for gw in range(1, 39)]
        self.elements, self.history = [], {}
        for club in CLUBS:
            for position, _, _, slots in POSITIONS:
                for _ in range(slots):
                    self._player(len(self.elements) + 1, club, position, ids)
        teams = [{"id": i, "name": GAME_SPELLING[c], "short_name": c[:3].upper()} for c, i in ids.items()]
        types = [{"id": i, "singular_name": n, "singular_name_short": s, "squad_select": k, "squad_min_play": 1,
                  "squad_max_play": k} for i, n, s, k in POSITIONS]
        self.bootstrap = {"teams": teams, "element_types": types, "events": events, "elements": self.elements}
        (self.game_dir / "bootstrap.json").write_text(json.dumps(self.bootstrap, indent=1))
        (self.game_dir / "fixtures.json").write_text(json.dumps(self.fixtures, indent=1))
        for player, entries in self.history.items():
            if entries is not None:
                (self.game_dir / f"player_{player}.json").write_text(json.dumps({"history": entries, "fixtures": []}, indent=1))
        # A file of somebody who left the game.
        (self.game_dir / "player_99999.json").write_text(json.dumps({"history": self.history[2], "fixtures": []}))

    def _player(self, number, club, position, ids):
        r, price, entries = self.random, self.random.randint(40, 130), []
        for f in self.fixtures:
            if f["finished"] and ids[club] in (f["team_h"], f["team_a"]):
                home, price = f["team_h"] == ids[club], max(35, price + r.randint(-2, 2))
                minutes = r.choice([0, 20, 65, 90, 90])
                entries.append({
                    "element": number, "fixture": f["id"], "round": f["event"], "kickoff_time": f["kickoff_time"],
                    "opponent_team": f["team_a"] if home else f["team_h"], "was_home": home, "minutes": minutes,
                    "total_points": 0 if not minutes else r.randint(-1, 15), "goals_scored": r.randint(0, 2),
                    "assists": r.randint(0, 2), "clean_sheets": r.randint(0, 1), "goals_conceded": r.randint(0, 3),
                    "yellow_cards": r.randint(0, 1), "red_cards": 0, "saves": r.randint(0, 5), "bonus": r.randint(0, 3),
                    "bps": r.randint(0, 40), "influence": f"{r.random() * 50:.1f}", "creativity": "1.5", "threat": "2.0",
                    "ict_index": f"{r.random() * 10:.1f}", "value": price, "selected": r.randint(100, 9999),
                    "transfers_in": 5, "transfers_out": 6})
        # Player 1 has no stored history.
        self.history[number] = None if number == 1 else entries
        self.elements.append({
            "id": number, "code": 1000 + number, "first_name": "Ann", "second_name": f"Player{number}",
            "web_name": f"P{number}", "team": ids[club], "element_type": position, "now_cost": price,
            "selected_by_percent": f"{r.random() * 20:.1f}", "status": "a", "total_points": 1, "minutes": 1,
            "form": "1.0", "points_per_game": "2.5"})

    def facts(self):
        """(player, entry) pairs the warehouse should hold."""
        return [(p, e) for p, entries in self.history.items() for e in entries or []]
