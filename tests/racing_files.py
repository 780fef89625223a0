"""A tiny hand-written archive holding the awkward cases."""

import gzip
import os

CIRCUITS = """circuitId,circuitRef,name,location,country,lat,lng,alt,url
1,north,"North, Old Ring",Nordstadt,Norland,50.5,7.25,600,http://x
2,south,"The ""South"" Bowl",  Sudville  ,Sudia,-33.1,x,\\N,http://y
x,bad,Unparsable,Nowhere,N,1,1,1,http://z
"""
CONSTRUCTORS = """constructorId,constructorRef,name,nationality,url
1,red,Red Team,Norlander,u
2,blue,Blue Team,NULL,u
"""
DRIVERS = """driverId,driverRef,number,code,forename,surname,dob,nationality,url
1,ann,11,ANN,Ann,Alder,1990-05-17,Norlander,u
2,bob,\\N,BOB,Bob,Birch,1985-12-31,Sudian,u
3,cyd,null,CYD,\\N,Cedar,2020-02-30,,u
4,dan,44,DAN,Dan,Drift,1999-01-01,Sudian,u
"""
STATUS = """statusId,status
1,Finished
2,Disqualified
3,Collision damage
4,Withdrew
5,+1 Lap
6,Gremlins
7,\\N
"""
RACES = {
    2020: """raceId,year,round,circuitId,name,date,time,url,fp1_date,fp1_time
10,2020,1,1,Opening Prize,2020-03-01,14:00:00,u,2020-02-28,11:00:00
11,2020,2,2,Closing Prize,2020-06-07,9:05:01,u,\\N,\\N
""",
    2021: """raceId,year,round,circuitId,name,date,time,url
20,2021,1,1,Opening Prize,2021-03-07,\\N,u
""",
}
RESULTS_HEADER = (
    "resultId,raceId,driverId,constructorId,number,grid,position,positionText,positionOrder,"
    "points,laps,time,milliseconds,fastestLap,rank,fastestLapTime,fastestLapSpeed,statusId\n"
)
RESULTS = {
    2020: RESULTS_HEADER
    + """100,10,1,1,11,1,1,1,1,25,50,1:30:00,5400000,40,1,1:27.452,210.5,1
101,10,2,1,22,0,2,2,2,18,50,+5.0,5405000,41,2,1:28.000,209.5,1
102,10,4,2,44,3,\\N,R,3,0,12,\\N,\\N,\\N,\\N,\\N,\\N,3
103,11,1,1,11,2,2,2,2,18,50,x,5400000,40,1,junk,210.5,5
104,11,2,1,22,1,1,1,1,25.555,50,x,5400000,40,1,22.879,210.5,99
105,11,77,2,77,4,3,3,3,15,50,x,5400000,40,1,\\N,210.5,1
106,10
107,10,3,2,33,41,4,4,4,51,50,x,1,1,1,\\N,1,6,extra,fields
108,10,3,2,"33,1,1,1
""",
    2021: RESULTS_HEADER
    + """200,20,1,1,11,1,3,3,3,15,50,x,5400000,40,1,1:27.452,210.5,1
201,20,2,2,22,2,1,1,1,25,50,x,5400000,40,1,1:27.452,210.5,1
""",
}
PIT_STOPS = {
    2020: """raceId,driverId,stop,lap,time,duration,milliseconds
10,1,1,20,14:30:00,0.999,999
10,1,2,30,14:45:00,1.000,1000
10,2,1,21,14:31:00,5:00.000,300000
10,2,01,22,14:32:00,22.879,\\N
10,4,1,23,14:33:00,300.001,300001
11,1,1,20,9:31:00,1:02.500,
11,x,1,20,9:31:00,1:02.500,5
""",
}


def write(root, seasons=(2020, 2021), packed=(2021,)):
    """Stage the archive: whole dimension files, one folder per season for the rest."""
    for name, text in (
        ("circuits", CIRCUITS), ("constructors", CONSTRUCTORS), ("drivers", DRIVERS),
        ("status", STATUS),
    ):
        _put(os.path.join(root, name, f"{name}.csv"), text)
    for name, by_season in (("races", RACES), ("results", RESULTS), ("pit_stops", PIT_STOPS)):
        for season in seasons:
            if season in by_season:
                suffix = ".csv.gz" if season in packed else ".csv"
                path = os.path.join(root, name, f"season={season}", f"{name}_{season}{suffix}")
                _put(path, by_season[season])


def _put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if path.endswith(".gz") else open
    with opener(path, "wt", encoding="utf-8") as out:
        out.write(text)
