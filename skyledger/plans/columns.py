"""Column lists of the feature build."""

# The model inputs of the reference pipeline.
NUMERIC_FEATURES = ["HourlyPrecipitation", "HourlyDryBulbTemperature", "HourlyRelativeHumidity",
                    "HourlySeaLevelPressure", "HourlyStationPressure", "HourlyVisibility", "HourlyWindSpeed",
                    "IS_HOLIDAY", "HOLIDAY_RUSH", "Recency", "Monetary", "Frequency", "ELEVATION",
                    "weather_condition_measured_time_from_depart", "degree_centrality",
                    "betweenness_centrality", "closeness_centrality", "airport_rank"]
CATEGORICAL_FEATURES = ["R_Quartile", "F_Quartile", "M_Quartile", "closest_depart_time_weather_measurement",
                        "SEASON", "TIME_SLOT", "airport_groups", "carrier_groups", "DAY_OF_MONTH"]
ONEHOT_FEATURES = [c + "_onehot" for c in CATEGORICAL_FEATURES]
CORRELATION_FEATURES = ["HourlyPrecipitation", "HourlyDryBulbTemperature", "HourlyRelativeHumidity",
                        "HourlySeaLevelPressure", "HourlyStationPressure", "HourlyVisibility", "HourlyWindSpeed",
                        "IS_HOLIDAY", "HOLIDAY_RUSH", "Recency", "Monetary", "Frequency",
                        "degree_centrality", "betweenness_centrality", "closeness_centrality", "airport_rank",
                        "ELEVATION", "DEP_DEL15"]
LABEL = "DEP_DEL15"
FEATURES = "input_features"
CARRIER_KEYS = ["OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM"]
WEATHER = ["HourlyPrecipitation", "HourlyDryBulbTemperature", "HourlyPressureChange", "HourlyRelativeHumidity",
           "HourlySeaLevelPressure", "HourlyStationPressure", "HourlyVisibility", "HourlyWindGustSpeed",
           "HourlyWindSpeed", "ELEVATION"]
SPARSE = ["HourlyPressureChange", "HourlyWindGustSpeed"]
REQUIRED = ["FL_DATE", "OP_UNIQUE_CARRIER", "TAIL_NUM", "OP_CARRIER_FL_NUM", "sched_depart_date_time_UTC", LABEL]
