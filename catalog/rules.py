"""The one complete published tree, for scoring rows by fixed rules."""

# Fixed values: (feature position, threshold, rules if <=, rules if >), classes
# as strings. Positions are those of the interaction matrix, from 0.
INTERACTION_TREE = (
    79, 0.50,
    (82, 0.50,
     (1, 25.50,
      (36, 0.50,
       (34, 0.50,
        (21, 0.50,
         (11, 4.50,
          (7, 11.04,
           (14, 13.50,
            (8, 1.50, "high", "medium"),
            "low"),
           "low"),
          (57, 0.50, "low", "medium")),
         (6, 5.50,
          (11, 0.50, "medium", "high"),
          "low")),
        (3, 132.50,
         (7, 12.47,
          (0, -0.38,
           "none",
           (7, 7.36, "low", "none")),
          "low"),
         (89, 0.50,
          (16, 0.50, "none", "none"),
          "medium"))),
       (7, 7.03, "none", "none")),
      (7, 8.32,
       (89, 0.50,
        (14, 1.50, "low", "high"),
        (0, 1.15,
         "low",
         (1, 34.50, "low", "high"))),
       "none")),
     (7, 5.99,
      (6, 5.50, "low", "none"),
      "none")),
    (16, 0.50, "none", "low"),
)

# Tests on a way that the shortened print shows.
PRINTED_DEPTH = 5
