"""Thresholds and fixed values of the analytics, in one place."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    current_season: str = "2627"
    seasons: tuple[str, ...] | None = None  # each must have its match file; None takes what is there
    century: str = "20"
    matches_per_completed_season: int = 380
    matches_per_team_per_season: int = 38
    max_plausible_goals: int = 12
    max_matches_played_spread: int = 2
    min_price: float = 3.0
    max_price: float = 20.0
    max_minutes: int = 120
    value_minutes: int = 270
    trend_minutes: int = 180
    full_game_minutes: int = 60
    usable_minutes: int = 90
    differential_ownership: float = 5.0
    form_span: int = 4
    small_sample: int = 60
    calendar_tail_days: int = 7
    # Seasons whose crowds were restricted.
    season_notes: dict = field(default_factory=lambda: {
        "1920": "partial_behind_closed_doors",
        "2021": "behind_closed_doors",
    })


# Spelling in the match files -> canonical club name.
MATCH_NAMES = {
    "Arsenal": "Arsenal",
    "Aston Villa": "Aston Villa",
    "Bournemouth": "AFC Bournemouth",
    "Brentford": "Brentford",
    "Brighton": "Brighton & Hove Albion",
    "Burnley": "Burnley",
    "Cardiff": "Cardiff City",
    "Chelsea": "Chelsea",
    "Coventry": "Coventry City",
    "Crystal Palace": "Crystal Palace",
    "Everton": "Everton",
    "Fulham": "Fulham",
    "Huddersfield": "Huddersfield Town",
    "Hull": "Hull City",
    "Ipswich": "Ipswich Town",
    "Leeds": "Leeds United",
    "Leicester": "Leicester City",
    "Liverpool": "Liverpool",
    "Luton": "Luton Town",
    "Man City": "Manchester City",
    "Man United": "Manchester United",
    "Middlesbrough": "Middlesbrough",
    "Newcastle": "Newcastle United",
    "Norwich": "Norwich City",
    "Nott'm Forest": "Nottingham Forest",
    "Sheffield United": "Sheffield United",
    "Sheffield Utd": "Sheffield United",
    "Southampton": "Southampton",
    "Stoke": "Stoke City",
    "Sunderland": "Sunderland",
    "Swansea": "Swansea City",
    "Tottenham": "Tottenham Hotspur",
    "Watford": "Watford",
    "West Brom": "West Bromwich Albion",
    "West Ham": "West Ham United",
    "Wolves": "Wolverhampton Wanderers",
}

# Spelling in the fantasy game's documents -> canonical club name.
GAME_NAMES = {
    "Arsenal": "Arsenal",
    "Aston Villa": "Aston Villa",
    "Bournemouth": "AFC Bournemouth",
    "Brentford": "Brentford",
    "Brighton": "Brighton & Hove Albion",
    "Burnley": "Burnley",
    "Chelsea": "Chelsea",
    "Coventry": "Coventry City",
    "Coventry City": "Coventry City",
    "Crystal Palace": "Crystal Palace",
    "Everton": "Everton",
    "Fulham": "Fulham",
    "Hull": "Hull City",
    "Hull City": "Hull City",
    "Ipswich": "Ipswich Town",
    "Ipswich Town": "Ipswich Town",
    "Leeds": "Leeds United",
    "Leicester": "Leicester City",
    "Liverpool": "Liverpool",
    "Man City": "Manchester City",
    "Man Utd": "Manchester United",
    "Newcastle": "Newcastle United",
    "Nott'm Forest": "Nottingham Forest",
    "Southampton": "Southampton",
    "Spurs": "Tottenham Hotspur",
    "Sunderland": "Sunderland",
    "West Ham": "West Ham United",
    "Wolves": "Wolverhampton Wanderers",
}
