"""Fixed values of the event feed: these must equal the provider's codes."""

PASS, OFFSIDE_PASS, TAKE_ON, FOUL, CORNER = 1, 2, 3, 4, 6
TACKLE, INTERCEPTION, SAVE, CLAIM, CLEARANCE = 7, 8, 10, 11, 12
MISS, POST, SAVED, GOAL, CARD = 13, 14, 15, 16, 17
PUNCH, SKILL, AERIAL, CHALLENGE, RECOVERY, DISPOSSESSED, ERROR = 41, 42, 44, 45, 49, 50, 51
PICKUP, TOUCH, BLOCK = 52, 61, 74
SHOTS = (MISS, POST, SAVED, GOAL)

# Event types by possession class: active ones show who has the ball.
ACTIVE = (1, 2, 3, 8, 11, 13, 14, 15, 16, 42, 49, 50, 52, 54, 59, 61)
PASSIVE = (7, 10, 12, 41, 44, 45, 51, 53, 56, 60, 74)
NEUTRAL = (4, 6, 17, 18, 19, 30, 32, 34, 40, 55, 58, 10000)
#: Events that aren't actions on the ball.
ADMIN = (17, 18, 19, 30, 32, 34, 40)

# Qualifier types.
Q_LONG, Q_CROSS, Q_THROUGH, Q_FREE_KICK, Q_CORNER, Q_PENALTY, Q_HEAD, Q_RIGHT, Q_OTHER_PART, Q_REGULAR = 1, 2, 4, 5, 6, 9, 15, 20, 21, 22
Q_FAST_BREAK, Q_DIRECT, Q_ASSIST_EVENT, Q_LEFT, Q_THROW_IN, Q_GOAL_KICK, Q_FORMATION = 23, 26, 55, 72, 107, 124, 130
Q_INTENTIONAL_ASSIST, Q_THROUGH_BALL, Q_TO_ATTEMPT, Q_TO_GOAL, Q_SHOT_ASSIST, Q_INDIVIDUAL, Q_OPPOSITE, Q_INDIRECT, Q_DEFENSIVE, Q_OFFENSIVE = 154, 155, 169, 170, 210, 215, 233, 241, 285, 286
Q_GOAL_ASSIST, Q_BIG_CHANCE, Q_KEY_PASS = 11111, 11112, 11113

BODY_PARTS = {15: "head", 20: "right_foot", 72: "left_foot", 21: "other"}
#: Counters of a player's match that come as minute series.
COUNTERS = (
    "touches possession passesTotal passesAccurate passesKey shotsTotal shotsOnTarget shotsOffTarget shotsBlocked shotsOnPost dribblesAttempted dribblesWon dribblesLost dribbledPast dispossessed "
    "tacklesTotal tackleSuccessful tackleUnsuccesful interceptions clearances aerialsTotal aerialsWon offensiveAerials defensiveAerials foulsCommited offsidesCaught errors "
    "cornersTotal cornersAccurate throwInsTotal throwInsAccurate totalSaves parriedSafe parriedDanger claimsHigh collected"
).split()
#: Matches that a suspended season lost: season, leagues, first date.
SUSPENDED = [("2019-2020", ("Ligue 1", "Ligue 2"), "2020-03-08")]
