"""Names, codes, patterns and orders that decide the results.

They come from the public data sets (NOAA local climatological data, NYC motor
vehicle collisions, MTA daily ridership), and some are the labels of the published
results (classes of collisions, parties, names of measures). They must be exactly these
values for the results to be right.
"""

from __future__ import annotations

# --- fixed values: date and time patterns -----------------------------------
WEATHER_TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"
COLLISION_DATE_PATTERN = "yyyy-MM-dd"
COLLISION_TIME_PATTERN = "H:mm"
RIDERSHIP_DATE_PATTERN = "MM/dd/yyyy"
YEAR_MONTH_PATTERN = "yyyy-MM"

# --- fixed values: the studied year ------------------------------------------
FIRST_DAY = "2022-01-01"
LAST_DAY = "2022-12-31"

# --- fixed values: weather stations and report types -------------------------
STATION_CENTRAL_PARK = "72505394728"
STATION_LGA = "72503014732"
STATION_EWR = "72502014734"
STATION_NAMES = {
    STATION_EWR: "EWR",
    STATION_LGA: "LGA",
    STATION_CENTRAL_PARK: "Central Park",
}
REPORT_HOURLY = "FM-15"
REPORT_SPECIAL = "FM-16"
REPORT_SUMMARY_OF_DAY = "SOD"  # padded with blanks in the files; trimmed when read

# --- fixed values: trace precipitation ----------------------------------------
TRACE_MARK = "T"
TRACE_VALUE = "0.00"

# --- fixed values: weather codes ----------------------------------------------
WEATHER_CODES = {
    "RA": "Rain",
    "FZRA": "Freezing Rain",
    "BR": "Mist",
    "SN": "Snow",
    "BLSN": "Blowing Snow",
    "FG": "Fog",
    "FZFG": "Freezing Fog",
    "HZ": "Haze",
    "TS": "Thunderstorm",
    "PL": "Ice Pellets",
    "GR": "Hail",
    "DZ": "Drizzle",
    "FZDZ": "Freezing Drizzle",
    "UP": "Unknown",
}
CONDITION_CODES = {"rain": "RA", "snow": "SN", "mist": "BR", "haze": "HZ", "fog": "FG"}

# --- fixed values: calendar orders ---------------------------------------------
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
SEASON_MONTHS = {
    "Winter": [12, 1, 2],
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Autumn": [9, 10, 11],
}
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# --- fixed values: collision classes --------------------------------------------
SEVERE = "Dangerous"
NOT_SEVERE = "Non-Injury"
OTHERS = "Others"
NO_PARTY = "Vehicle"
BOROUGHS = ["BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND"]

# --- fixed values: column names in the raw files -> names used here --------------
WEATHER_COLUMNS = {
    "STATION": "station",
    "DATE": "ts",
    "REPORT_TYPE": "report_type",
    "SOURCE": "source",
    "DailyWeather": "daily_weather",
    "HourlyAltimeterSetting": "altimeter_setting",
    "HourlyDewPointTemperature": "dew_point_temperature",
    "HourlyDryBulbTemperature": "dry_bulb_temperature",
    "HourlyPrecipitation": "precipitation",
    "HourlyPresentWeatherType": "present_weather_type",
    "HourlyPressureChange": "pressure_change",
    "HourlyPressureTendency": "pressure_tendency",
    "HourlyRelativeHumidity": "relative_humidity",
    "HourlySeaLevelPressure": "sea_level_pressure",
    "HourlySkyConditions": "sky_conditions",
    "HourlyStationPressure": "station_pressure",
    "HourlyVisibility": "visibility",
    "HourlyWetBulbTemperature": "wet_bulb_temperature",
    "HourlyWindDirection": "wind_direction",
    "HourlyWindGustSpeed": "wind_gust_speed",
    "HourlyWindSpeed": "wind_speed",
    "Sunrise": "sunrise",
    "Sunset": "sunset",
}
COLLISION_COLUMNS = {
    "CRASH DATE": "crash_date",
    "CRASH TIME": "crash_time",
    "BOROUGH": "borough",
    "ZIP CODE": "zip_code",
    "LATITUDE": "latitude",
    "LONGITUDE": "longitude",
    "LOCATION": "location",
    "ON STREET NAME": "on_street_name",
    "CROSS STREET NAME": "cross_street_name",
    "OFF STREET NAME": "off_street_name",
    "NUMBER OF PERSONS INJURED": "ppl_i",
    "NUMBER OF PERSONS KILLED": "ppl_k",
    "NUMBER OF PEDESTRIANS INJURED": "ped_i",
    "NUMBER OF PEDESTRIANS KILLED": "ped_k",
    "NUMBER OF CYCLIST INJURED": "cyc_i",
    "NUMBER OF CYCLIST KILLED": "cyc_k",
    "NUMBER OF MOTORIST INJURED": "mot_i",
    "NUMBER OF MOTORIST KILLED": "mot_k",
    "CONTRIBUTING FACTOR VEHICLE 1": "factor_1",
    "CONTRIBUTING FACTOR VEHICLE 2": "factor_2",
    "CONTRIBUTING FACTOR VEHICLE 3": "factor_3",
    "CONTRIBUTING FACTOR VEHICLE 4": "factor_4",
    "CONTRIBUTING FACTOR VEHICLE 5": "factor_5",
    "COLLISION_ID": "collision_id",
    "VEHICLE TYPE CODE 1": "vehicle_1",
    "VEHICLE TYPE CODE 2": "vehicle_2",
    "VEHICLE TYPE CODE 3": "vehicle_3",
    "VEHICLE TYPE CODE 4": "vehicle_4",
    "VEHICLE TYPE CODE 5": "vehicle_5",
}
RIDERSHIP_COLUMNS = {
    "Date": "date",
    "Subways: Total Estimated Ridership": "sub",
    "Buses: Total Estimated Ridership": "bus",
    "LIRR: Total Estimated Ridership": "lirr",
    "Metro-North: Total Estimated Ridership": "metro_north",
    "Access-A-Ride: Total Scheduled Trips": "acc_a_ride",
    "Bridges and Tunnels: Total Traffic": "brdg_tun",
    "Staten Island Railway: Total Estimated Ridership": "sttn_rw",
}

# --- fixed values: columns that are computed on, so that a file must have them --------
WEATHER_REQUIRED = [
    "station", "ts", "report_type", "daily_weather", "dry_bulb_temperature",
    "relative_humidity", "precipitation", "sunrise", "sunset",
]
COLLISION_REQUIRED = [
    "crash_date", "crash_time", "borough",
    "ppl_i", "ppl_k", "ped_i", "ped_k", "cyc_i", "cyc_k", "mot_i", "mot_k",
    "vehicle_1", "vehicle_2", "vehicle_3", "vehicle_4", "vehicle_5",
]

# --- fixed values: which measures each report uses ---------------------------------
CASUALTIES = ["ppl_i", "ppl_k", "ped_i", "ped_k", "cyc_i", "cyc_k", "mot_i", "mot_k"]
TRANSIT_MODES = ["sub", "bus", "lirr", "metro_north", "acc_a_ride", "brdg_tun", "sttn_rw"]
PROFILE_MODES = ["sub", "bus", "acc_a_ride", "brdg_tun", "sttn_rw"]
SHARE_MODES = ["sub", "bus", "brdg_tun"]
SPREAD_MODES = ["sub", "bus", "brdg_tun"]
IMPACT_CONDITIONS = ["rain", "snow", "fog", "haze", "mist"]
WEATHER_MEASURES = ["min_t", "max_t", "avg_t", "sunrise", "sunset"]
MODEL_FEATURES = ["min_t", "max_t", "sub", "bus"]
MODEL_LABELS = ["crash", "ppl_i", "ppl_k"]
TRAIN_PARTS, HOLDOUT_PARTS = 7, 3

# --- fixed values: labels shown to readers ------------------------------------------
LABELS = {
    "min_t": "min t", "max_t": "max t", "avg_t": "avg t",
    "sunrise": "Sunrise", "sunset": "Sunset",
    "rain": "Rain", "snow": "Snow", "mist": "Mist", "haze": "Haze", "fog": "Fog",
    "ppl_i": "ppl i", "ppl_k": "ppl k", "ped_i": "ped i", "ped_k": "ped k",
    "cyc_i": "cyc i", "cyc_k": "cyc k", "mot_i": "mot i", "mot_k": "mot k",
    "metro_north": "metro-north", "acc_a_ride": "acc-a-ride",
    "brdg_tun": "brdg-tun", "sttn_rw": "sttn-rw",
}
